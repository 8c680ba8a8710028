"""Token counts of byte-level BPE by dynamic programming over prefixes.

The last token of each prefix of a piece (a match of the split pattern) decides its encoding: token ``t`` of
``n`` bytes is the last one of prefix ``i`` if the last token ``p`` of prefix ``i - n`` and ``t`` are what the merges
make of their joined bytes, and only one ``t`` is.  So ``count[i] = count[i - n] + 1`` is exact for every prefix.  An
automaton over the vocabulary lists the tokens that end at each byte, and pairs are tested by undoing merges.
Distinct pieces are encoded once for each run of texts and remembered by a worker (``REMEMBERED`` at most).

``count_tokens`` gives the number of tokens; with ``prefixes`` also that of every prefix (by code points),
from which ``longest_prefix`` and ``tokens_of_prefix`` answer questions of truncation and budget in plain SQL
functions.  Counts may fall as a prefix grows, so the longest prefix within a budget is looked for from the end.

The tokenizer file is read by the driver and broadcast (a few MB).  It must be byte-level BPE with the usual pattern and
without normaliser; anything else is an error.  Which characters are letters, numbers and blanks is asked of the library,
as its Unicode version decides.  Added tokens in a text count as one token each, as is the library's default.

A null text is empty: no bytes and no tokens.  Texts of any length are counted whole, in parts cut before a blank that
follows a non-blank, where no piece can lie across (a text without such a place is one part); the counts of all prefixes of a
text are one array value.  Repeated rows are counted alike, each on its own; an empty table gives an empty result.
Added columns replace columns of the same name.  There are no ties: the encoding is unique.
"""

from __future__ import annotations

import json

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A

FILE = "byte_bpe_50k.json"
LIMIT = 1024
#: Distinct pieces whose counts a worker remembers, and pairs of tokens whose test it does.
REMEMBERED = 1 << 19
#: Code points that are split and hashed at a time.
RUN = 1 << 20
LETTER, NUMBER, BLANK = 1, 2, 3
#: Contractions that the split pattern keeps whole.
SHORT, LONG = ("s", "t", "m", "d"), ("re", "ve", "ll")
_ALL = range(0x110000)


def classes(tokenizer) -> np.ndarray:
    """The class of every code point as the library's split pattern sees it.  Its Unicode version is no newer than
    that of ``regex``, so only what that calls a letter or number is asked."""
    every = "".join(chr(c) for c in _ALL if not 0xD800 <= c < 0xE000)
    out = np.zeros(len(_ALL), np.uint8)
    out[[ord(c) for c in regex.findall(r"\s", every)]] = BLANK
    for kind, lead, pattern in ((LETTER, "a", r"\p{L}"), (NUMBER, "1", r"\p{N}")):
        asked = np.array([ord(c) for c in regex.findall(pattern, every)])
        for part in np.array_split(asked, 1 + len(asked) // 20_000):
            text = "".join(f"{lead}{chr(c)}\n" for c in part)
            joined = [a // 3 for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text) if a % 3 == 0 and b - a >= 2]
            out[part[joined]] = kind
    return out


def specification(path: str) -> tuple[str, np.ndarray]:
    """What workers need: the tokenizer's file and the classes of characters."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        raw = f.read()
    spec = json.loads(raw)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and model["type"] == "BPE"
    odd = spec.get("normalizer") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or odd or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])):
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    return raw, classes(Tokenizer.from_str(raw))


def byte_letters() -> dict[str, int]:
    """The printable letter by which such files write each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Counter:
    """Encoder of distinct pieces.  Tokens are numbered by their merge: bytes first, then in the order of merges."""

    def __init__(self, raw: str, kinds: np.ndarray):
        spec, letter = json.loads(raw), byte_letters()
        self.kinds, self.memory, self.tested = kinds, {}, {}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        texts = [bytes([b]) for b in range(256)]
        number = {t: i for i, t in enumerate(texts)}
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            left, right = (number[bytes(letter[c] for c in x)] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.merged[left, right] = number[texts[left] + texts[right]] = len(texts)
            self.parts.append((left, right))
            texts.append(texts[left] + texts[right])
        # A token can end a prefix only if its own bytes are encoded as that token.
        sound = [True] * 256
        for t, (left, right) in enumerate(self.parts[256:], 256):
            sound.append(sound[left] and sound[right] and self.adjacent(left, right, t))
        self.automaton = ahocorasick.Automaton()
        for t, x in enumerate(texts):
            if sound[t]:
                self.automaton.add_word(x.decode("latin-1"), (len(x), t))
        self.automaton.make_automaton()

    def adjacent(self, left: int, right: int, limit: int = 1 << 60) -> bool:
        """Whether the merges keep the border between two tokens: their last merges are undone, the later one
        first, and no pair across the border may have been merged before the merge that is undone."""
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, inner = left, self.parts[left][1]
                if inner != left:
                    left = inner
                    continue
                limit, inner = right + 1, self.parts[right][0]
                if inner == right:
                    return True
                right = inner
            else:
                limit, inner = right + 1, self.parts[right][0]
                if inner != right:
                    right = inner
                    continue
                limit, inner = left, self.parts[left][1]
                if inner == left:
                    return True
                left = inner

    def prefix_counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of every prefix of each piece, one after the other: ``len(piece) + 1`` numbers each."""
        joined = "Ā".join(p.decode("latin-1") for p in pieces)  # no token has the letter between
        last, count, tested = [-1] * (len(joined) + 1), [0] * (len(joined) + 1), self.tested
        for end, (n, t) in self.automaton.iter(joined):
            if last[end + 1] >= 0:
                continue
            p = last[end + 1 - n]
            if p >= 0:
                fits = tested.get((p, t))
                if fits is None:
                    if len(tested) >= REMEMBERED:
                        tested.clear()
                    fits = tested[p, t] = self.adjacent(p, t)
                if not fits:
                    continue
            last[end + 1] = t
            count[end + 1] = count[end + 1 - n] + 1
        return np.array(count, np.int32)

    def piece_counts(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each piece, distinct ones encoded once."""
        some, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        keys = some.tolist()
        known = [self.memory.get(k) for k in keys]
        new = [i for i, x in enumerate(known) if x is None]
        if new:
            at = first[new]
            pieces = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            counts = self.prefix_counts(pieces)
            at_end = np.cumsum([len(p) + 1 for p in pieces]) - 1
            if len(self.memory) + len(new) > REMEMBERED:
                self.memory.clear()
            for i, n in zip(new, counts[at_end].tolist(), strict=True):
                known[i] = n
                if len(self.memory) < REMEMBERED:
                    self.memory[keys[i]] = n
        return np.array(known, np.int64)[back]

    def split(self, text: str, bounds: np.ndarray):
        """Where pieces start (code points), and the code points and classes; no piece crosses ``bounds``."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.kinds[points]
        n = len(points)
        start = np.ones(n + 1, bool)
        start[1:n] = kind[1:] != kind[:-1]
        cuts = np.zeros(n + 1, bool)
        cuts[bounds] = True
        start |= cuts
        # The blank before something else is its own piece, or part of the next one if it is a space.
        after = np.flatnonzero((kind[1:] != BLANK) & (kind[:-1] == BLANK) & ~cuts[1:n]) + 1
        start[after - 1] = True
        start[after[points[after - 1] == 0x20]] = False
        # Contractions at the start of a piece.
        mark = np.flatnonzero((points == 0x27) & start[:n])
        for short, texts in ((1, SHORT), (2, LONG)):
            for t in texts:
                at = mark[mark + short < n]
                for j, c in enumerate(t, 1):
                    at = at[(points[at + j] == ord(c)) & ~cuts[at + j]]
                start[at + 1] = False
                start[at + 1 + short] = True
        return np.flatnonzero(start[:n]), points, kind

    def places(self, text: str, points: np.ndarray) -> np.ndarray:
        """Byte offset of every code point, and of the end."""
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        return np.concatenate([[0], np.cumsum(width)])

    def totals(self, segments: list[str]) -> np.ndarray:
        """Tokens of each of some plain segments."""
        text = "".join(segments)
        bounds = np.cumsum([0, *map(len, segments)])
        if not text:
            return np.zeros(len(segments), np.int64)
        starts, points, _ = self.split(text, bounds)
        data = text.encode()
        byte = self.places(text, points)[np.append(starts, len(points))]
        hashes = A.range_hash(A.prefix_hash(np.frombuffer(data, np.uint8)), byte[:-1], byte[1:])
        counts = self.piece_counts(hashes, data, byte[:-1], byte[1:])
        running = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(running[np.searchsorted(starts, bounds)])

    def segments(self, text: str, size: int):
        """``(segment, special token after it or "")``: cut at special tokens and, beyond ``size``, before blanks."""
        at = 0
        for m in self.cut.finditer(text) if self.cut else ():
            yield from self._parts(text[at : m.start()], size, m[0])
            at = m.end()
        yield from self._parts(text[at:], size, "")

    def _parts(self, text: str, size: int, then: str):
        at = 0
        while len(text) - at > size:
            m = _BORDER.search(text, at + size)
            if not m:
                break
            yield text[at : m.start()], ""
            at = m.start()
        yield text[at:], then

    def all_prefixes(self, text: str) -> np.ndarray:
        """Tokens of every prefix of a text by code points, the empty one first."""
        out, base = [np.zeros(1, np.int64)], 0
        for segment, special in self.segments(text, RUN):
            counts = self._prefixes(segment + special[:-1])
            out.append(base + counts[1:])
            base += int(counts[len(segment)])
            if special:
                base += 1
                out.append(np.array([base]))
        return np.concatenate(out)

    def _prefixes(self, text: str) -> np.ndarray:
        """``all_prefixes`` of plain text.  A piece of a prefix differs from those of the text in two cases: blanks at
        the end are one piece, and a contraction that is cut within its letters is none."""
        n = len(text)
        if not n:
            return np.zeros(1, np.int64)
        starts, points, kind = self.split(text, np.array([0, n]))
        data, byte = text.encode(), self.places(text, points)
        first = np.append(starts, n)
        blank = np.concatenate([[False], kind == BLANK, [False]])
        begins, ends = np.flatnonzero(~blank[:-1] & blank[1:]), np.flatnonzero(blank[:-1] & ~blank[1:])
        long = (ends - begins > 1) & (ends < n)
        begins, ends = begins[long], ends[long]
        lo, hi = np.concatenate([first[:-1], begins]), np.concatenate([first[1:], ends])
        hashes = A.range_hash(A.prefix_hash(np.frombuffer(data, np.uint8)), byte[lo], byte[hi])
        _, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        pieces = [data[a:b] for a, b in zip(byte[lo[one]].tolist(), byte[hi[one]].tolist(), strict=True)]
        counts = self.prefix_counts(pieces).astype(np.int64)
        origin = np.concatenate([[0], np.cumsum([len(p) + 1 for p in pieces])[:-1]])[back]
        total = counts[origin + byte[hi] - byte[lo]]
        before = np.concatenate([[0], np.cumsum(total[: len(starts)])])
        piece = np.repeat(np.arange(len(starts)), np.diff(first))
        out = np.zeros(n + 1, np.int64)
        out[1:] = before[piece] + counts[origin[piece] + byte[1:] - byte[starts[piece]]]
        if len(ends):
            out[ends] = before[np.searchsorted(starts, begins)] + total[len(starts) :]
        inner = starts[(np.diff(first) == 3) & (points[starts] == 0x27)]
        inner = inner[kind[inner + 1] == LETTER] if len(inner) else inner
        out[inner + 2] = before[np.searchsorted(starts, inner)] + 2
        return out


_BORDER = regex.compile(r"(?<=\S)(?=\s)")
_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str | None = None, text_col: str = "text", keep: list[str] | None = None, prefixes: bool = False) -> DataFrame:
    """``keep`` columns of every row (default: all) with ``n_bytes``, ``n_tokens`` and, if asked for, ``prefix_tokens``:
    the tokens of every prefix, from that of no code point to that of all."""
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))] if prefixes else []
    added = [f.name for f in fields]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    path = path or public_tokenizers.path(FILE)
    shared = docs.sparkSession.sparkContext.broadcast((path, *specification(path)))

    def counter() -> Counter:
        path, raw, kinds = shared.value
        if path not in _counters:
            _counters[path] = Counter(raw, kinds)
        return _counters[path]

    def kernel(data, offsets, valid):
        texts = [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        n_bytes = pa.array(np.diff(offsets))
        if prefixes:
            counts = [counter().all_prefixes(t) for t in texts]
            every = pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int32())
            return [n_bytes, pa.array([int(c[-1]) for c in counts], pa.int64()), A.list_array(np.array([len(c) for c in counts]), every)]
        totals = np.zeros(len(texts), np.int64)
        held, owner, size = [], [], 0

        def flush():
            np.add.at(totals, owner, counter().totals(held))

        for i, text in enumerate(texts):
            for segment, special in counter().segments(text, RUN):
                totals[i] += special != ""
                held.append(segment)
                owner.append(i)
                size += len(segment)
                if size > RUN:
                    flush()
                    held, owner, size = [], [], 0
        if held:
            flush()
        return [n_bytes, pa.array(totals)]

    return A.arrow_map(docs, kernel, text_col, keep, fields, chunk=RUN)


def tokens_of_prefix(prefix_tokens: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` code points; null beyond the text."""
    return F.get(prefix_tokens, n_chars.cast("int"))


def longest_prefix(prefix_tokens: Column, budget: int | Column) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens; null for a negative budget."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    from_end = F.array_position(F.reverse(F.transform(prefix_tokens, lambda n: n <= budget)), True)
    return F.when(from_end > 0, F.size(prefix_tokens) - from_end)


def truncate(docs: DataFrame, budget: int, path: str | None = None, text_col: str = "text") -> DataFrame:
    """The rows with their text cut to the longest prefix of at most ``budget`` tokens; nulls stay."""
    counted = count_tokens(docs.withColumnsRenamed({c: f"k_{c}" for c in docs.columns}), path, f"k_{text_col}", prefixes=True)
    cut = F.substring(F.col(f"`k_{text_col}`"), F.lit(1), longest_prefix(F.col("prefix_tokens"), budget).cast("int"))
    return counted.select(*((cut if c == text_col else F.col(f"`k_{c}`")).alias(c) for c in docs.columns))


def op11(spark, sf_dir):
    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
