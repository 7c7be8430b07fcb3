import pickle

from textloom.llm import licences

PLAIN = [f"the river runs by the {a} and the {b} in the morning" for a in ("mill", "hill", "wood", "town") for b in ("bridge", "field", "lake")]


def test_every_template_and_no_other_text(spark):
    model = pickle.loads(pickle.dumps(licences.fit(PLAIN)))
    for family, some in licences.TEMPLATES.items():
        for text in some:
            assert model.judge(licences.words_of(text))[0] == family, text
    assert {model.judge(licences.words_of(t))[0] for t in (*licences.OTHER, *PLAIN)} == {"unknown"}


def test_cases(spark):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, "\n\n . \n"), (4, f"{PLAIN[0]}\n{mit}\n{PLAIN[1]}"), (4, mit), (5, " ".join(PLAIN * 400) + " " + mit), (6, f"{mit}\nLicensed under CC BY-NC 4.0."), (7, PLAIN[2])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licence string")
    model = licences.train(docs)
    got = sorted(licences.scan(docs, model).collect(), key=lambda r: (r.doc_id, r.n_paragraphs))
    assert [(r.doc_id, r.n_notices > 0, r.families) for r in got] == [(1, False, ""), (2, False, ""), (3, False, ""), (4, True, "mit"), (4, True, "mit"), (5, True, "mit"), (6, True, "cc-by-nc,mit"), (7, False, "")]
    assert got[0].n_paragraphs == got[1].n_paragraphs == got[2].n_paragraphs == 0 and got[4].n_paragraphs == 3
    assert {(r.doc_id, r.line) for r in licences.notices(docs, model).collect()} >= {(4, 1), (4, 0), (6, 0), (6, 1)}
    empty = docs.limit(0)
    assert licences.scan(empty, licences.train(empty)).count() == 0


OTHERS = {
    "cc-by-sa": "This article is licensed under CC BY-SA 4.0",
    "lgpl": "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, version 3",
    "agpl": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3 of the License",
    "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    "bsd": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "apache-2.0": "you may not use this file except in compliance with the License. Licensed under the Apache License, Version 2.0",
}
REFUSED = ("The author rejected the Apache License, Version 2.0 proposal", "we do not grant the rights of the GNU General Public License to anyone", "The article compares the MIT License with others")


def test_other_wordings_and_refusals():
    model = licences.fit(PLAIN)
    judged = {want: model.judge(licences.words_of(text))[0] for want, text in OTHERS.items()}
    assert {w: g for w, g in judged.items() if w != g} == {}
    assert [model.judge(licences.words_of(t))[0] for t in REFUSED] == ["unknown"] * len(REFUSED)


def test_ties_and_probabilities():
    model = licences.fit(PLAIN)
    p = model.probabilities(model.grams(licences.words_of("Released under the MIT License.")))
    assert abs(p.sum() - 1) < 1e-9 and len(p) == len(licences.FAMILIES)
    flat = licences.Model({}, model.w[:0], model.bias * 0, 1.0)
    assert flat.judge(["any", "words"])[0] == "unknown"


def test_wrapped_notices_are_found_once():
    model = licences.fit(PLAIN)
    for family, text in (("mit", licences.TEMPLATES["mit"][2]), ("apache-2.0", licences.TEMPLATES["apache-2.0"][2]), ("gpl", licences.TEMPLATES["gpl"][1])):
        words = text.split()
        for width in (3, 4):
            lines = [" ".join(words[i : i + width]) for i in range(0, len(words), width)]
            for before, after in (([], []), (PLAIN[:1], []), ([*PLAIN[:9], ""], ["", *PLAIN[:9]])):
                _, found = licences.grants("\n".join([*before, *lines, *after]), model.judge)
                assert {f[1] for f in found} == {family}, (family, width, len(before), found)
    assert licences.grants("\n".join(PLAIN * 30), model.judge) == (len(PLAIN) * 30, [])
    cut = licences.TEMPLATES["mit"][0].split()
    assert licences.grants("\n\n".join(cut), model.judge)[1] == []  # an empty line ends a paragraph


def test_windows_over_lines_are_those_of_a_plain_rule():
    """Every run of lines without a notice is read in windows of WINDOW words, STRIDE apart, and its end."""
    seen = []

    def judge(words):
        seen.append(tuple(words))
        return ("mit" if "notice" in words and len(words) == 1 else "unknown", 0.9, 1.0)

    lines = [" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate((5, 40, 30, 1, 70, 8))]
    assert licences.grants("\n".join([*lines, "notice", "a b", "c", "", "d"]), judge) == (11, [(6, "mit", 0.9, 1.0)])
    run = " ".join(lines).split()
    want = [tuple(run[i : i + 64]) for i in range(0, len(run) - 63, 32)]
    want.append(tuple(run[32 * len(want) :]))
    own = lambda part: len({w.split("x")[0] for w in part})
    assert [w for w in want if own(w) > 1] == [s for s in seen if own(s) > 1 and s[0] in run]
    assert ("a", "b", "c") in seen and ("c", "d") not in seen
