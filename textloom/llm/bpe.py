"""Byte-pair encoding without merging: one dynamic-programming pass over each piece of text.

A sequence of tokens is what merging gives exactly if every two neighbours are compatible: encoding their joined
bytes gives just these two. Each prefix of a valid encoding is valid, so every prefix of a piece has one valid last
token. For each prefix, longest match first, the pass takes the token that ends there (found by walking a suffix
automaton of the vocabulary) whose remaining prefix is reachable and whose own last token is compatible, and stores
it; back-pointers then give the ids. Compatibility of two tokens is found by undoing their merges from the highest
rank down, and is remembered.

Text is first split at special tokens and then into pieces by the tokenizer's pattern, as the library does. Pieces
repeat, so a worker remembers the ids of up to twice ``REMEMBERED`` of them; that changes no result.

Cases: a null text counts as empty and has no ids; texts of any length are encoded whole, piece by piece; equal rows
get equal rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from textloom.runtime import resident, ship

# Fixed value: the pattern by which byte-level vocabularies of this kind split text. Words stand first: no other form
# but theirs fits where they do, and most pieces are words.
PIECES = r""" ?\p{L}+| ?\p{N}+|'(?:[stmd]|re|ve|ll)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces in each of two memories: some 120 MB a worker when both are full.
REMEMBERED = 300_000
PAIRS = 300_000
LONGEST_REMEMBERED = 64


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable ones as themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class SuffixAutomaton:
    """Recognises every substring of the tokens it is built from.

    ``held[s]`` are the tokens among state s's own strings, and ``up[s]`` is the next state along suffix links that
    holds any, so the tokens that end at a place are found longest first.
    """

    def __init__(self, tokens: dict[bytes, int]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for token in tokens:
            last = 0
            for b in token:
                last = self._extend(last, b)
        self.held: dict[int, list[tuple[int, int]]] = {}
        for token, i in tokens.items():
            at = 0
            for b in token:
                at = self.next[at][b]
            self.held[at] = sorted([*self.held.get(at, ()), (len(token), i)], reverse=True)
        self.chains: dict[int, list[tuple[int, int]]] = {}
        self.up = [0] * len(self.link)
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for s in order:
            above = self.link[s]
            self.up[s] = above if above and above in self.held else self.up[above] if above > 0 else 0

    def _extend(self, last: int, b: int) -> int:
        """The state after ``last`` on byte b, made if need be (the generalised construction, a token at a time)."""
        nxt, link, length = self.next, self.link, self.length
        if b in nxt[last]:
            q = nxt[last][b]
            return q if length[q] == length[last] + 1 else self._clone(last, b, q)
        new = len(link)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and b not in nxt[p]:
            nxt[p][b] = new
            p = link[p]
        if p != -1:
            q = nxt[p][b]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, b, q)
        return new

    def _clone(self, p: int, b: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(link)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(b) == q:
            nxt[p][b] = copy
            p = link[p]
        return copy

    def ending(self, state: int) -> list[tuple[int, int]]:
        """(length, id) of every token that is a suffix of the state's longest string, longest first."""
        found = self.chains.get(state)
        if found is None:
            found, s = [], state
            while s > 0:
                found += self.held.get(s, ())
                s = self.up[s]
            self.chains[state] = found
        return found


class Encoder:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids: dict[bytes, int] = {to_bytes(t): i for t, i in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.bytes_of = [names.get(i, b"") for i in range(max(names) + 1)]
        for t in self.special:
            self.ids.pop(t.encode(), None)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: rank of the merge that makes a token, and its halves, for tokens that merging can make
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            left, right = self.ids[to_bytes(a)], self.ids[to_bytes(b)]
            whole = self.ids[to_bytes(a) + to_bytes(b)]
            self.merge[left, right] = (rank, whole)
            if whole not in self.rank:
                self.rank[whole], self.halves[whole] = rank, (left, right)
        usable = {b: i for b, i in self.ids.items() if (len(b) == 1 or i in self.rank) and self._merged(b) == [i]}
        self.automaton = SuffixAutomaton(usable)
        self.pairs: dict[int, bool] = {}
        self.pieces = regex.compile(PIECES)
        self.specials = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _merged(self, text: bytes) -> list[int]:
        """The ids by plain merging, lowest rank first. Used once for each token, to leave out unreachable ones."""
        ids = [self.ids[text[i : i + 1]] for i in range(len(text))]
        while len(ids) > 1:
            best = min((self.merge[p][0], i) if (p := (ids[i], ids[i + 1])) in self.merge else (1 << 60, i) for i in range(len(ids) - 1))
            if best[0] == 1 << 60:
                break
            ids[best[1] : best[1] + 2] = [self.merge[ids[best[1]], ids[best[1] + 1]][1]]
        return ids

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives a, b: no merge across their border comes before theirs.

        Undo merges from the last: at each step the half at the border of the token made later is taken; a pair at
        the border that merges earlier than what was just undone would have been merged first.
        """
        limit, rank, halves, merge = 1 << 60, self.rank, self.halves, self.merge
        while True:
            across = merge.get((a, b))
            if across is not None and across[0] < limit:
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra == rb == -1:
                return True
            if ra > rb:
                limit = ra
                a = halves[a][1]
                # a merge on the left at the same rank comes first, so an equal rank across is late
            else:
                limit = rb + 1  # on the right, the pair across starts further left: at an equal rank it comes first
                b = halves[b][0]

    def piece(self, text: bytes) -> bytes:
        """The ids of one piece: the last token of every prefix, then back-pointers."""
        automaton, pairs = self.automaton, self.pairs
        nxt, link, length, chains = automaton.next, automaton.link, automaton.length, automaton.chains
        last, start = [0] * (len(text) + 1), [0] * (len(text) + 1)
        at = n = end = 0
        for b in text:
            end += 1
            to = nxt[at].get(b)
            while to is None:
                at = link[at]
                n = length[at]
                to = nxt[at].get(b)
            at = to
            n += 1
            for size, i in chains.get(at) or automaton.ending(at):
                if size > n:
                    continue
                before = end - size
                if before:
                    key = last[before] << 20 | i
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self._compatible(last[before], i)
                    if not fits:
                        continue
                last[end] = i
                start[end] = before
                break
            else:
                raise ValueError(f"no valid token ends at byte {end}")
        out = array("I")
        while end:
            out.append(last[end])
            end = start[end]
        out.reverse()
        return out.tobytes()

    def _fetch(self, piece: str) -> bytes:
        """The ids of a piece that the younger memory lacks. Two memories, so that frequent pieces outlive a full one."""
        ids = self.old.get(piece)
        if ids is None:
            ids = self.piece(piece.encode("utf-8", "replace"))
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def packed(self, text: str) -> bytes:
        """The ids of a text as unsigned 32-bit integers."""
        out: list[bytes] = []
        for odd, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if odd % 2:
                out.append(array("I", [self.special[part]]).tobytes())
                continue
            known = self.young.get  # stays right, if older, when the memories change
            out += [known(p) or self._fetch(p) for p in self.pieces.findall(part)]
        return b"".join(out)

    def encode(self, text: str) -> array:
        return array("I", self.packed(text))

    def decode(self, ids: array) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def encoder(path: str) -> Encoder:
    """The encoder that this process keeps."""
    return resident(Encoder, path)


def digests(path: str, texts: Iterator[str | None]) -> Iterator[tuple[int, str, str]]:
    coder = encoder(path)
    for text in texts:
        ids = coder.encode(text or "")
        little = array("I", ids)
        if sys.byteorder == "big":
            little.byteswap()
        yield len(ids), hashlib.sha256(little).hexdigest(), hashlib.sha256(coder.decode(ids).encode()).hexdigest()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: the whole text of each row as token ids."""
    ship(docs.sparkSession)

    def run(batches):
        coder = encoder(path)
        for batch in batches:
            ids = [coder.encode(t.as_py() or "").tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows as ``encode`` gives them."""
    ship(rows.sparkSession)

    def run(batches):
        coder = encoder(path)
        for batch in batches:
            texts = [coder.decode(array("I", x.as_py() or ())) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded in one pass."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            got = list(digests(path, (t.as_py() for t in batch.column(1))))
            columns = zip(*got, strict=True) if got else ([], [], [])
            n, a, b = (list(c) for c in columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
