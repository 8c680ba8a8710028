"""Operators against brute force, on small texts with nulls, empties, ties, repeated rows and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from curalis.llm import decontam, html, langid, licenses, mixing, quality, simhash, substring, suffix_dedup, toxicity
from tests.conftest import DATA

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, oid string, tag string, size string, bucket string, h string, fp string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\v\f\r"


def docs(spark, texts, langs=None, sources=None, ids=None):
    """Rows with columns whose names the operators use inside."""
    rows = []
    for i, t in enumerate(texts):
        rows.append((ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else f"s{i % 3}", len(t or ""), *["x"] * 7))
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, words=None):
    return " ".join(rng.choice(words or VOCAB) for _ in range(n))


_r = random.Random(3)
VOCAB = ["".join(_r.choice("abcdefghijklmnop") for _ in range(_r.randint(2, 7))) for _ in range(900)]
ODD = [None, "", " \n\t ", "word", "é😀 ñandú", "#$% |||", "a" * 5000, "x y " * 3000]


# -- exact substrings
def removed(texts, ids):
    raw = [(t or "").encode() for t in texts]
    keys = [-(2**63) if i is None else i for i in ids]
    first = {}
    for k, b in zip(keys, raw):
        for p in range(len(b) - 49 if k != -(2**63) else 0):
            s = b[p : p + 50]
            first[s] = min(first.get(s, k), k)
    out = []
    for k, b in zip(keys, raw):
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first.get(b[p : p + 50], k) < k:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("heavy", [8, 0])
def test_suffix_dedup(spark, monkeypatch, heavy):
    rng = random.Random(1)
    common = prose(rng, 14)
    texts = list(ODD)
    for i in range(60):
        t = prose(rng, rng.randint(5, 80), VOCAB[:40] if i % 3 else None)
        if i % 2:
            t += common[rng.randint(0, 10) :] + prose(rng, 5)
        if i % 7 == 0:
            t = rng.choice(texts) or t
        if i % 5 == 0:
            base = rng.choice([x for x in texts if x and len(x) > 60])
            cut = rng.randint(0, len(base) - 55)
            t += base[cut : cut + rng.choice([49, 50, 51, 200])]
        texts.append(t)
    texts += [common * 2 + "é" * 30, "ab" * 40, "ab" * 60, "aba" * 30]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[5] = None
    texts += [texts[20], texts[20], "same id other text " + common]
    ids += [ids[20], 1000, 1000]
    # Many rows without an id, and many texts of one id.
    more = [prose(rng, 30) + common + str(i) for i in range(300)]
    texts += more
    ids += [None] * 150 + [2000] * 150
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    got = suffix_dedup.repeated_spans(docs(spark, texts, ids=ids).repartition(5), keep=["doc_id", "score", "oid"])
    want = Counter((i, *x) for i, x in zip(ids, removed(texts, ids), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.removed_spans), r.kept_sha256) for r in got.collect()) == want
    assert suffix_dedup.repeated_spans(docs(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("heavy", [8, 0])
def test_suffix_dedup_evidence_of_removed_bytes(spark, monkeypatch, heavy):
    """A window whose bytes two smaller documents cover, but neither holds, is still first in its document."""
    rng = random.Random(4)
    texts, ids = [], []
    for i in range(40):
        d = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400))
        c = rng.randint(100, 250)
        at = c - rng.randint(20, 45)
        noise = ["".join(rng.choice("ABCDEFGHIJ") for _ in range(60)) for _ in range(4)]
        texts += [d[: c + 20] + noise[0], noise[1] + d[c:], d, noise[2] + d[at : at + rng.randint(50, 75)] + noise[3]]
        ids += [i, 100 + i, 200 + i, 300 + i]
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    got = suffix_dedup.repeated_spans(docs(spark, texts, ids=ids).repartition(5), keep=["doc_id"])
    want = Counter((i, *x) for i, x in zip(ids, removed(texts, ids), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.removed_spans), r.kept_sha256) for r in got.collect()) == want


# -- near-duplicate passages
def test_substring(spark):
    rng = random.Random(5)
    passage = prose(rng, 60).split()
    near = list(passage)
    near[30] = "changed"
    texts = [*ODD, prose(rng, 200), *(f"{prose(rng, 40)} {' '.join(p)} {prose(rng, 30)}" for p in (passage, passage, near)), prose(rng, 300), " ".join(passage[:49])]
    ids = [None if i == 3 else i for i in range(len(texts))]
    found = substring.matches(docs(spark, texts, ids=ids)).collect()
    assert {(r.doc, r.other) for r in found if r.doc >= 9} == {(10, 9), (11, 9)} | {(r.doc, r.other) for r in found if (r.doc, r.other) == (11, 10)}
    for r in found:
        if r.doc >= 9:
            assert 40 <= r.start <= 41 and 99 <= r.end <= 100 and r.similarity >= 0.8
    assert all(r.tag == 0 for r in found)
    kept = {r.doc_id: r for r in substring.remove_passages(docs(spark, texts, ids=ids)).collect()}
    assert kept[9].text == texts[9] and kept[10].text.split() == texts[10].split()[:40] + texts[10].split()[100:]
    assert kept[10].n_chars == len(kept[10].text) and kept[12].text == texts[12] and kept[10].score == "x"
    assert substring.matches(docs(spark, texts).limit(0)).count() == 0


def test_substring_repeated_ids(spark):
    """Rows with one id and different texts are judged each on its own, in whatever order they come."""
    rng = random.Random(15)
    passage = prose(rng, 60)
    texts = [passage + " " + prose(rng, 60), prose(rng, 100), prose(rng, 40) + " " + passage, prose(rng, 90) + " é", None, passage, passage]
    ids = [1, 5, 5, 5, 5, None, 5]
    for order in (range(7), reversed(range(7))):
        order = list(order)
        kept = substring.remove_passages(docs(spark, [texts[i] for i in order], ids=[ids[i] for i in order]))
        got = Counter((r.doc_id, r.text and r.text.strip()) for r in kept.collect())
        assert got == Counter([(1, texts[0]), (5, texts[1]), (5, texts[2][: -len(passage)].strip()), (5, texts[3]), (5, None), (None, passage)])


def test_substring_recall_of_near_passages(spark):
    """Passages of 100 words with some changed, among documents that crowd the same hashes."""
    rng = random.Random(16)
    common = prose(rng, 55)
    texts, similar = [], {}
    for i in range(120):
        p = prose(rng, 100).split()
        near = list(p)
        for at in rng.sample(range(2, 98), 1 + i % 2):
            near[at] = "other"
        texts += [f"{prose(rng, 30)} {common} {' '.join(p)}", f"{common} {prose(rng, 30)} {' '.join(near)} {prose(rng, 30)}"]
        similar[2 * i + 1] = 2 * i
    found = {(r.doc, r.other) for r in substring.matches(docs(spark, texts)).collect() if r.start > 55}
    assert np.mean([(a, b) in found for a, b in similar.items()]) >= 0.95


def test_substring_finds_every_exact_passage(spark):
    rng = random.Random(8)
    pool = [prose(rng, rng.randint(50, 90)) for _ in range(6)]
    texts = [" ".join([prose(rng, rng.randint(0, 60)), rng.choice(pool), prose(rng, rng.randint(0, 60)), rng.choice(pool)]) for _ in range(40)]
    words = [t.split() for t in texts]
    first, cover = {}, {}
    for i, w in enumerate(words):
        for p in range(len(w) - 49):
            if first.setdefault(tuple(w[p : p + 50]), i) < i:
                cover.setdefault(i, set()).update(range(p, p + 50))
    got = {}
    for r in substring.matches(docs(spark, texts).repartition(7)).collect():
        got.setdefault(r.doc, set()).update(range(r.start, r.end))
    assert {i: len(c - got.get(i, set())) for i, c in cover.items()} == dict.fromkeys(cover, 0)


def test_substring_finds_passages_of_common_lines(spark):
    """Lines that many documents share must not hide the one document that has the whole passage."""
    rng = random.Random(11)
    lines = [prose(rng, 14) for _ in range(6)]
    passages = [[*rng.sample(lines, 3), prose(rng, 12)] for _ in range(12)]
    texts = []
    for i in range(160):
        body = [rng.choice(lines) for _ in range(3)] + [prose(rng, 12)]
        rng.shuffle(body)
        texts.append(" ".join([prose(rng, 30), *(body if i % 4 else rng.choice(passages)), prose(rng, 30)]))
    words = [t.split() for t in texts]
    first, cover = {}, {}
    for i, w in enumerate(words):
        for p in range(len(w) - 49):
            if first.setdefault(tuple(w[p : p + 50]), i) < i:
                cover.setdefault(i, set()).update(range(p, p + 50))
    got = {}
    for r in substring.matches(docs(spark, texts).repartition(5)).collect():
        got.setdefault(r.doc, set()).update(range(r.start, r.end))
    assert sum(len(c - got.get(i, set())) for i, c in cover.items()) <= 0.001 * sum(map(len, cover.values()))


def test_substring_finds_the_whole_passage_in_a_crowd(spark):
    """The first and the nearest documents of a crowd have parts of a passage only, others of it all; some parts twice."""
    rng = random.Random(12)
    whole = prose(rng, 64).split()
    texts = []
    for i in range(60):
        part = whole if i in (20, 40, 41, 59) else whole[:40] if i % 3 == 0 else whole[24:] if i % 3 == 1 else whole[12:52]
        texts.append(" ".join([prose(rng, 60), *part, prose(rng, 60), *(part[:30] if i % 4 == 0 else [])]))
    words = [t.split() for t in texts]
    first, cover = {}, {}
    for i, w in enumerate(words):
        for p in range(len(w) - 49):
            if first.setdefault(tuple(w[p : p + 50]), i) < i:
                cover.setdefault(i, set()).update(range(p, p + 50))
    assert set(cover) == {40, 41, 59}
    for parts in (1, 7):
        found = substring.matches(docs(spark, texts).repartition(parts)).collect()
        got = {}
        for r in found:
            got.setdefault(r.doc, set()).update(range(r.start, r.end))
        assert all(c <= got.get(i, set()) for i, c in cover.items())
        # Copies are matched with the document that stands for them.
        assert {(40, 20), (41, 20), (59, 20)} <= {(r.doc, r.other) for r in found}


# -- SimHash
def fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("large", [simhash.LARGE, 1])
def test_simhash(spark, monkeypatch, large):
    rng = random.Random(2)
    texts = list(ODD)
    for _ in range(25):
        w = prose(rng, rng.randint(1, 200)).split()
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = rng.choice(VOCAB)
            texts.append(" ".join(w))
    texts += texts[-3:]
    ids = [None if i == 4 else i for i in range(len(texts))]
    monkeypatch.setattr(simhash, "LARGE", large)
    monkeypatch.setattr(simhash, "BLOCK", 256 if large > 1 else 2)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts, ids=ids)).collect()}
    fp = [fingerprint(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 2 and 4 not in (i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    for i in range(len(texts)):
        if i != 4:
            assert (got[i].fingerprint, got[i].component_id, got[i].score) == (f"{fp[i]:016x}", find(i), "x")
    assert got[None].component_id is None
    kept = simhash.drop_near_duplicates(docs(spark, [*texts, texts[0]], ids=[*ids, 0]), setting=simhash.CONTRACT)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["None", *(str(i) for i in range(len(texts)) if i != 4 and find(i) == i)])
    assert simhash.near_duplicates(docs(spark, texts).limit(0)).count() == 0


def test_simhash_repeated_ids(spark):
    """Rows that share an id with a dropped one stay where their own text is no copy."""
    rng = random.Random(21)
    t, other, third = (prose(rng, 60) for _ in range(3))
    rows = [(3, t), (5, t), (5, other), (5, other), (7, third), (7, t), (None, t), (None, None), (9, None), (8, "")]
    kept = simhash.drop_near_duplicates(docs(spark, [x for _, x in rows], ids=[i for i, _ in rows]))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(3, t), (5, other), (7, third), (None, t), (None, None), (8, "")])


@pytest.mark.parametrize("setting", [simhash.CONTRACT, simhash.SIMILAR, simhash.Setting(5, 192, 28, 4, 6)])
def test_anchors_meet(setting):
    """Whatever differs by at most 1 bit in some block meets at an anchor; a home is within 1 of its member."""
    rng = np.random.default_rng(4)
    words = setting.bits // 64
    x = rng.integers(0, 1 << 63, (300, words)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    y = x.copy()
    for row in y:
        for bit in rng.choice(setting.blocks * setting.width, 2 * setting.blocks - 1, replace=False):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    for a, b in zip(x, y, strict=True):
        row, key, home = simhash.anchors(np.stack([a, b]), setting)
        assert set(key[(row == 0) & home]) & set(key[row == 1])
        assert len(set(key[row == 0])) == (row == 0).sum() and home[row == 0].sum() == setting.blocks


def test_large_anchor_links_alike():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 62, (3, 2)).astype(np.uint64)
    fp = base[rng.integers(0, 3, 3000)].copy()
    for _ in range(5):
        fp[np.arange(3000), rng.integers(0, 2, 3000)] ^= np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)
    home = rng.random(3000) < 0.2
    differ = np.bitwise_count(fp[home][:, None, :] ^ fp[None]).sum(2)
    i, j = np.nonzero(differ <= 14)
    u, v = simhash._links(fp, home, 14)
    assert (np.bitwise_count(fp[u] ^ fp[v]).sum(1) <= 14).all() and len(u) < len(i) / 2
    want = dict(zip(*map(list, simhash.forest(np.flatnonzero(home)[i], j)), strict=True))
    assert dict(zip(*map(list, simhash.forest(u, v)), strict=True)) == want


def test_similar_recall(spark):
    """Pairs by the similarity of their 5-word shingles: those of 0.8 or more are linked, others and unrelated texts
    stay apart, but for a few close to 0.8."""
    rng = random.Random(31)
    texts, similarity = [], {}

    def shingles(w):
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    for changes in (1, 4, 6, 9, 12, 18):
        for _ in range(60):
            w = prose(rng, 300).split()
            near = list(w)
            for at in rng.sample(range(300), changes):
                near[at] = "changed" + str(rng.random())[2:6]
            a, b = shingles(w), shingles(near)
            similarity[len(texts) + 1] = len(a & b) / len(a | b)
            texts += [" ".join(w), " ".join(near)]
    texts += ["one two three", "one two three", "one two four"]
    group = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, texts), keep=["doc_id"], setting=simhash.SIMILAR).collect()}
    assert all(group[i] in (i, i - 1) for i in group)

    def share(lo, hi):
        found = [group[i] == i - 1 for i, x in similarity.items() if lo <= x < hi]
        assert len(found) >= 20
        return np.mean(found)

    assert share(0.9, 1.1) == 1 and share(0.8, 0.9) >= 0.9
    assert share(0.74, 0.8) <= 0.05 and share(0, 0.74) == 0
    assert [group[len(texts) - k] for k in (3, 2, 1)] == [len(texts) - 3, len(texts) - 3, len(texts) - 1]


def test_simhash_verifies_other_pairs_of_groups_that_stay_apart(spark):
    """Of two groups the pair that is closest by fingerprint is not similar, another is."""
    setting = simhash.Setting(simhash.SIMILAR.shingle, 128, 40, 4, 3, sure=12)
    rng = random.Random(33)

    def changed(words, n):
        out = list(words)
        for at in rng.sample(range(len(out)), n):
            out[at] = "changed" + str(rng.random())[2:8]
        return out

    def similarity(a, b):
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        return len(a & b) / len(a | b)

    def bits(words):
        raw = " ".join(words).encode()
        return simhash.fingerprints(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), setting)

    # Two texts of one group and one beside: it is similar to the text that is farther by fingerprint.
    for _ in range(2_000):
        base = prose(rng, 200).split()
        a, b, c = base, changed(base, 4), changed(base, 4)
        one, two, three = bits(a), bits(b), bits(c)
        far, near, linked = (int(np.bitwise_count(x ^ y).sum()) for x, y in ((one, three), (two, three), (one, two)))
        if linked <= 12 < near < far <= 20 and similarity(a, c) >= 0.8 > similarity(b, c):
            break
    else:
        raise AssertionError("no such texts")
    texts = [" ".join(x) for x in (a, b, c)]
    group = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, texts), keep=["doc_id"], setting=setting).collect()}
    assert group == {0: 0, 1: 0, 2: 0}


# -- decontamination
@pytest.mark.parametrize("limit", [decontam.MAX_SET_BYTES, 200])
def test_decontamination(spark, limit):
    rng = random.Random(9)
    items = [prose(rng, 25), prose(rng, 10), "Short Item", "...", None, prose(rng, 12), prose(rng, 25)]
    items.append(items[0])
    bench = [(i, t) for i, t in enumerate(items)]
    texts = [*ODD, prose(rng, 50), prose(rng, 8) + " " + items[0].upper() + "!", "a short, item b", " ".join(items[5].split()[:9]), items[1] + "-" + items[6], items[0]]
    d, b = docs(spark, texts), spark.createDataFrame(bench, "item_id long, text string")
    got = decontam.find_contamination(d, b, keep=["doc_id"], max_set_bytes=limit)
    con = duckdb.connect()
    documents = pa.table({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})  # noqa: F841
    benchmark = pa.table({"item_id": [i for i, _ in bench], "text": pa.array(items, pa.string())})  # noqa: F841
    want = {r[0]: r[1:] for r in con.sql(decontam.ORACLE).fetchall()}
    for r in got.select("doc_id", "n_words", decontam.n_hit_words().alias("n_hit"), "hit_items").collect():
        assert (r.n_words, r.n_hit, len(r.hit_items), hashlib.sha256(",".join(r.hit_items).encode()).hexdigest(), r.n_hit > 0) == want[r.doc_id]
    assert {r.doc_id for r in decontam.remove_contaminated(d, b).collect()} == {i for i, x in want.items() if not x[1]}
    assert decontam.find_contamination(d.limit(0), b.limit(0)).count() == 0


# -- mixing
def water(sizes, weights, total):
    target, free = {}, set(sizes)
    while free:
        left = total - sum(target.values())
        w = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / w > 2 * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / w for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mixing(spark):
    rng = random.Random(6)
    texts = [*ODD, *(prose(rng, rng.randint(1, 80)) for _ in range(300))]
    sources = [rng.choice(["b", "Z", "é", None, "a", "hot", "hot", "hot"]) for _ in texts]
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    per = Counter()
    for s, n in zip(sources, size):
        per[s] += n
    order = sorted((s for s in per if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = water(per, weights, 1.5 * sum(per.values()))
    order_of = {s: i for i, s in enumerate(order)}.get
    d = docs(spark, texts, sources=sources)
    rows = mixing.curriculum(d).collect()
    taken = Counter()
    for r in rows:
        assert (r.size, r.source_size) == (size[r.doc_id], per[sources[r.doc_id]]) and r.score == "x"
        assert r.target == pytest.approx(target[sources[r.doc_id]]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in per)
    at = [r.copies[0].position for r in rows if r.copies]
    assert at == sorted(at) and 0 <= min(at) and max(at) <= 1
    again = {r.doc_id: r.taken for r in mixing.curriculum(d.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}
    order = mixing.training_order(d).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert Counter((r.doc_id, r.position, r.words) for r in order) == Counter((r.doc_id, c.position, c.words) for r in rows for c in r.copies)
    # Up to each position the mix has read what the source's schedule demands, integrated numerically.
    t = np.linspace(0, 1, 20_001)
    for k, s in enumerate(sorted(per, key=order_of)):
        g = mixing.TILTS[k % 3]
        demand = np.concatenate([[0], np.cumsum((1 + g * (1 - 2 * (t[1:] + t[:-1]) / 2)) * np.diff(t))]) * target[s]
        read = 0
        for r in (r for r in order if r.source == s):
            assert read == pytest.approx(np.interp(r.position, t, demand), abs=0.05)
            read += r.words
        assert read == pytest.approx(target[s], abs=1)
    assert mixing.curriculum(d.limit(0)).count() == 0
    assert [r.taken for r in mixing.curriculum(docs(spark, [None, ""])).collect()] == [0, 0]
    assert mixing.training_order(docs(spark, [None, ""])).count() == 0
    none = mixing.curriculum(docs(spark, [prose(rng, 5) for _ in range(9)], ids=[None] * 9)).collect()
    assert sum(r.taken for r in none) == pytest.approx(sum({r.source: r.target for r in none}.values()), abs=3)


# -- decision lists
def stats(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    hit = set()
    for i, x in enumerate(tri):
        if n[x] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit)


def test_quality_statistics(spark):
    rng = random.Random(7)
    texts = [*ODD, *(prose(rng, rng.randint(1, 200), VOCAB[:k]) for k in (2, 5, 20, 400)), "a b c a b c", "l\nl\n\n \nl\nm\v\nm", "x y z # <b>", "a\r\na\r\n"]
    got = quality.judge(docs(spark, texts), [([], 1)]).collect()
    for r in got:
        want = stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)
    assert quality.judge(docs(spark, texts).limit(0), [([], 1)]).count() == 0


def test_decision_list(spark):
    rng = random.Random(12)
    texts, labels = [], []
    for i in range(240):
        bad = i % 3 == 0
        texts.append(" ".join(w + ("$$$" if bad else "") for w in prose(rng, 80).split()))
        labels.append((i, 0 if bad else 1))
    d, y = docs(spark, texts), spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int")
    rules = quality.learn(d, y)
    assert len(rules) >= 2 and rules[-1][0] == []
    assert {r.doc_id: int(r.kept) for r in quality.judge(d, rules).collect()} == dict(labels)
    assert quality.learn(d, y.limit(0)) == [([], 1)]
    x = np.array([[0.0], [0.0], [1.0]])
    assert quality.cover(x, np.array([1, 1, 1]))[-1] == ([], 1)


# -- toxicity
def test_toxicity(spark):
    rng = random.Random(13)
    texts, labels = list(ODD), []
    for i in range(len(ODD), 600):
        bad = i % 4 == 0
        w = prose(rng, 60).split()
        if bad:
            w[rng.randrange(60)] = rng.choice(["zqidiot", "zqclown"])
        texts.append(" ".join(w))
        labels.append((i, int(bad)))
    d, y = docs(spark, texts), spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(d, y, lambda c: ~toxicity.held_out(c))
    got = {r.doc_id: r for r in toxicity.score(d, model, keep=["doc_id"]).collect()}
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == t for i, t in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values()) and got[0].score == got[1].score
    assert toxicity.score(d, toxicity.train(d, y.limit(0))).agg({"predicted": "max"}).first()[0] == 0
    assert toxicity.score(d, toxicity.train(d, y.where("toxic = 1"))).agg({"score": "min"}).first()[0] == 1.0
    assert toxicity.drop_toxic(d.limit(0), model).count() == 0


# -- language
def test_language(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.train(d, lambda c: ~langid.held_out(c))
    rows = langid.predict(d, model, keep=["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]) >= 0.95
    got = {r.doc_id: r for r in langid.predict(docs(spark, [*ODD, "123 — !", "ñ"]), model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 5, 8)] == ["und"] * 5 and got[9].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values()) and got[0].word_langs == [0] * len(model[0])
    empty = langid.train(d.limit(0))
    assert {r.lang_pred for r in langid.predict(docs(spark, ODD), empty).collect()} == {"und"}
    mixed = next(r.text for r in d.where("lang = 'fr' and n_chars > 500").collect()) + "\n" + next(r.text for r in d.where("lang = 'de' and n_chars > 500").collect())
    counts = dict(zip(model[0], langid.predict(docs(spark, [mixed]), model).first().word_langs, strict=True))
    assert counts["fr"] > 50 and counts["de"] > 50


@pytest.mark.parametrize("text", ["this is plan b", "b", "", "a b c", "ab", "x\n", "ñ", "word é", "ab " * 9 + "c"])
def test_language_of_chunks_that_end_in_short_words(text):
    lexicon, table, trans = langid.fit(["this is the plan\nof a day", "voici le plan\ndu jour b"], np.array([0, 1]), 2)
    raw = np.frombuffer(text.encode(), np.uint8)
    low, starts, ends, affixes, tri, stops = langid.features(raw, np.array([0, len(raw)]), lexicon)
    got = langid._emissions(table, affixes, tri, starts, stops)
    want = [sum((table[r] for r in [*affixes[i], *(tri[j] for j in range(starts[i], ends[i] - 2))]), np.zeros(2)) for i in range(len(starts))]
    assert np.allclose(got, np.array(want).reshape(-1, 2))


def test_forward_backward():
    import itertools

    rng = np.random.default_rng(0)
    e, t = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    gamma, pairs = langid.posteriors(e, t, np.array([0, 3]), np.array([3, 2]), pairs=True)
    want, want_pairs = np.zeros((5, 3)), np.zeros((3, 3))
    for first, n in ((0, 3), (3, 2)):
        paths = list(itertools.product(range(3), repeat=n))
        w = np.array([np.exp(sum(e[first + i, y] for i, y in enumerate(p)) + sum(t[a, b] for a, b in itertools.pairwise(p))) for p in paths])
        for p, x in zip(paths, w / w.sum(), strict=True):
            for i, y in enumerate(p):
                want[first + i, y] += x
            for a, b in itertools.pairwise(p):
                want_pairs[a, b] += x
    assert np.allclose(gamma, want) and np.allclose(pairs, want_pairs)


# -- licenses
def brute_licenses(t, templates):
    """Containment of every template at every offset, without retrieval."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    found = set()
    for name, texts in templates.items():
        for x in texts:
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.translate(LOWER))
            k = min(5, len(w))
            grams = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            own = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
            for s in range(max(1, len(own) - len(grams) + 1)):
                if len(set(own[s : s + len(grams)]) & set(grams)) >= 0.8 * len(set(grams)):
                    found.add(name)
                    break
    return found


def test_licenses(spark):
    rng = random.Random(4)
    texts, want = list(ODD), [set() for _ in ODD]
    for name, versions in licenses.TEMPLATES.items():
        for x in versions:
            texts.append(f"{prose(rng, rng.randint(0, 90))}\n{x.upper() if rng.random() < 0.5 else x}\n{prose(rng, rng.randint(0, 90))}")
            want.append({name})
    near = " ".join(w if i % 60 != 31 else "changed" for i, w in enumerate(licenses.TEMPLATES["BSD-3-Clause"][0].split()))
    texts += [prose(rng, 90), prose(rng, 33) + " " + near + " " + prose(rng, 9), "released under the license", licenses.TEMPLATES["MIT"][0] + " " + licenses.TEMPLATES["Zlib"][0]]
    want += [set(), {"BSD-3-Clause"}, set(), {"MIT", "Zlib"}]
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs(spark, texts)).collect()}
    assert {i: {m.license for m in got[i]} for i in got} == dict(enumerate(want))
    assert all(len(got[i]) == len(w) for i, w in enumerate(want))
    at = len(ODD)
    head = len(re.findall(r"\w+", texts[at].split("\n")[0]))
    assert abs(got[at][0].start - head) <= 1 and got[at][0].containment >= 0.9
    assert licenses.scan_licenses(docs(spark, texts).limit(0)).count() == 0
    assert not any(r.licenses for r in licenses.scan_licenses(docs(spark, texts), {}).collect())


def test_license_recall(spark, tmp_path):
    """Against brute force over all offsets, on texts with some words changed, with templates of a folder."""
    rng = random.Random(40)
    templates = {f"L{i}": [prose(rng, n)] for i, n in enumerate((3, 6, 9, 17, 40, 64, 130, 400))}
    for name, (x,) in templates.items():
        (tmp_path / f"{name}.txt").write_text(x)
    assert licenses.read_templates(spark, str(tmp_path)) == templates
    texts = []
    for x in templates.values():
        for _ in range(12):
            w = x[0].split()
            for _ in range(rng.randint(0, max(1, len(w) // 22))):
                w[rng.randrange(len(w))] = "other"
            texts.append(f"{prose(rng, rng.randint(0, 200))} {' '.join(w)} {prose(rng, rng.randint(0, 200))}")
    hit = {r.doc_id: {m.license for m in r.licenses} for r in licenses.scan_licenses(docs(spark, texts), templates).collect()}
    want = {i: brute_licenses(t, templates) for i, t in enumerate(texts)}
    assert sum(map(len, want.values())) > 60
    assert hit == want


# -- very long texts
def test_very_long_texts(spark):
    """A text of 120,000 words, and one that repeats most of it, in every operator on documents."""
    rng = random.Random(50)
    head, body = prose(rng, 20_000), prose(rng, 100_000)
    texts = [head + " " + body, body + " " + "Released under the MIT License.", "short"]
    words = [len(t.split()) for t in texts]
    d = docs(spark, texts)
    cut = {r.doc_id: r for r in suffix_dedup.repeated_spans(d, keep=["doc_id"]).collect()}
    assert cut[1].n_removed == len(body) and cut[0].n_removed == cut[2].n_removed == 0
    found = substring.matches(d).collect()
    assert {(r.doc, r.other) for r in found} == {(1, 0)}
    assert set().union(*(range(r.start, r.end) for r in found)) >= set(range(100_000))
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(d, keep=["doc_id"], setting=simhash.SIMILAR).collect()} == {0: 0, 1: 0, 2: 2}
    bench = spark.createDataFrame([(7, " ".join(texts[0].split()[-12:]))], "item_id long, text string")
    assert {r.doc_id: (r.n_words, len(r.hit_items)) for r in decontam.find_contamination(d, bench, keep=["doc_id"]).collect()} == {0: (words[0], 1), 1: (words[1], 1), 2: (1, 0)}
    assert {r.doc_id: [m.license for m in r.licenses] for r in licenses.scan_licenses(d, keep=["doc_id"]).collect()} == {0: [], 1: ["MIT"], 2: []}
    assert {r.doc_id: r.n_words for r in quality.judge(d, [([], 1)], keep=["doc_id"]).collect()} == dict(enumerate(words))
    assert {r.doc_id: r.size for r in mixing.curriculum(d, keep=["doc_id"]).collect()} == dict(enumerate(words))
    model = ["a", "b"], *langid.fit(["ab cd ef gh", "ij kl mn op"], np.array([0, 1]), 2)
    assert {r.doc_id: sum(r.word_langs) for r in langid.predict(d, model, keep=["doc_id"]).collect()} == dict(enumerate(words))
    assert all(0 <= r.score <= 1 for r in toxicity.score(d, toxicity.fit(["ab", "cd"], np.array([0.0, 1.0]), np.ones(2))).collect())


# -- pages
PAGES = [
    (None, ""),
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<html><body><nav><a href=x>menu</a></nav><article><h1>Title</h1><p>One  two<br>three.<p>Four</article><footer>f</footer>", "Title\nOne two three.\nFour"),
    ("<body><header>top</header><div class='ad'>buy</div><div id=c><p>A long first paragraph with words, and more.</p><p>A second long paragraph&nbsp;here.</p></div><div class=comments><p>first!</p></div><form><p>mail</p></form>", "A long first paragraph with words, and more.\nA second long paragraph here."),
    ("<article><p>x<script>var a='</p>';</script>y</p><aside>side</aside><p hidden>no</p></article>", "xy"),
    ("<article><p>cut &am", "cut &am"),
    ("<p>a<b>b</b>c</p>", "abc"),
    ("a < b and c > d", "a < b and c > d"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
]


def test_pages(spark):
    df = spark.createDataFrame([(i, "u", p, "x") for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    rows = {r.page_id: r for r in html.extract(df).collect()}
    assert {i: rows[i].text for i in rows} == {i: w for i, (_, w) in enumerate(PAGES)}
    assert all(r.n_chars == len(r.text) and r.url == "u" for r in rows.values())
    assert html.extract(df.limit(0)).count() == 0


LONG = ["the first words of the text stand on their own and go on for a while " * 5, "a second part says more about it", "and so does a third", "the rest of the text lies in an article of its own, a little longer than the first one's parts are"]
FEW = "".join(f"<p>paragraph {i} of the first article with its few words</p>" for i in range(6))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<body><div>{0}<br>More.<div><p>{1}</p><p>{2}</p></div></div></body>", "{0} More.\n{1}\n{2}"),
        ("<body>{0}<div><p>{1}</p><p>{2}</p></div></body>", "{0}\n{1}\n{2}"),
        ("<body><div><p>{1}</p><p>{2}</p></div><hr>{0} <b>and</b> end</body>", "{1}\n{2}\n{0} and end"),
        ("<body><a href=a>Home</a> <a href=b>About us</a><div><p>{0}</p><p>{0}</p></div></body>", "{0}\n{0}"),
        (f"<body><article>{FEW}</article><article><p>{{3}}</p></article></body>", "\n".join([*FEW[3:-4].split("</p><p>"), "{3}"])),
        (f"<body>{{0}}<main>{FEW}</main><div><a href=a>x</a><a href=b>y</a></div></body>", "\n".join(["{0}", *FEW[3:-4].split("</p><p>")])),
    ],
)
def test_html_text_beside_the_chosen_node(page, want):
    parts = [" ".join(x.split()) for x in LONG]
    assert html.main_text(page.format(*parts)) == want.format(*parts)


ARTICLE = "<p>The article has a long first paragraph with many words in it, and goes on.</p><p>And a second one that is as long as the first, more or less.</p>"
PLAIN = "The article has a long first paragraph with many words in it, and goes on.\nAnd a second one that is as long as the first, more or less."


@pytest.mark.parametrize("opening", ['<div class="layout has-sidebar">', '<div id="post-with-comments">', '<div class="content search-result">', '<form action="x">', "<div class=sidebar>", "<div><span><i>"])
def test_html_keeps_the_article(opening):
    assert html.main_text(f"<body><nav><a href=x>menu</a></nav>{opening}{ARTICLE}</body>") == PLAIN


@pytest.mark.parametrize("part", ['<div class="cookie-banner">We use cookies, accept them.</div>', "<div class='comment-list'><p>first! I do not agree with this at all, it is wrong.</p></div>", "<aside>By the way, this is not the article.</aside>", "<section id=relatedPosts><a href=x>other</a> and more of it</section>", "<footer>all rights reserved by us</footer>"])
def test_html_cuts_what_is_not_the_article(part):
    for page in (f"<body>{part}<div>{ARTICLE}</div></body>", f"<body><main>{ARTICLE}{part}</main></body>"):
        assert html.main_text(page) == PLAIN


def test_html_density_by_brute_force():
    """Counts and densities of every node, recomputed from the tree by recursion."""
    import math

    rng = random.Random(17)

    def page(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            out.append(prose(rng, rng.randint(0, 12)))
            if depth:
                tag = rng.choice(["div", "b", "a", "span", "section", "ul"])
                out.append(f"<{tag}>{page(depth - 1)}</{tag}>")
        return " ".join(out)

    def count(n, linked):
        linked = linked or n.tag == "a"
        c = sum(len("".join(x[0].split())) for x in n.parts if isinstance(x, tuple))
        lc, t, lt = c * linked, 0, 0
        for k in n.children:
            a = count(k, linked)
            c, lc, t, lt = c + a[0], lc + a[1], t + a[2] + 1, lt + a[3] + (k.tag == "a")
        return c, lc, t, lt

    for _ in range(30):
        root = html.parse(page(4))
        html.cut_suspects(root)
        whole = count(root, False)
        nodes = html.measure(root)
        for n in nodes:
            linked, up = False, n.parent
            while up is not None:
                linked, up = linked or up.tag == "a", up.parent
            c, lc, t, lt = count(n, linked)
            assert (n.chars, n.link_chars, n.tags, n.link_tags) == (c, lc, t, lt)
            one = lambda x: max(x, 1)
            base = math.log(c / one(c - lc) * one(lc) + whole[1] / one(whole[0]) * c + math.e)
            want = c / one(t) * math.log(c / one(lc) * one(t) / one(lt)) / math.log(base) if c else 0
            assert n.density == pytest.approx(want) and n.total == pytest.approx(sum(k.density for k in n.children) if n.children else want)


def test_html_time_is_linear():
    import time

    def seconds(n):
        began = time.perf_counter()
        for page in ("<div>" * n + "</section>" * n, '<a "' + "<a " * n, "<li><b>" * n, "<p><i>" * n, "<!--" * n, "<a href='" * n):
            html.main_text(page)
        return time.perf_counter() - began

    seconds(1_000)
    assert seconds(20_000) < 30 * max(seconds(2_000), 0.02)


# -- op2: what names and attributes say
PROSE = "<p>" + " ".join(f"word{i} and more text" for i in range(60)) + "</p>"
SHORT = "<p>" + " ".join(f"remark{i} is short" for i in range(12)) + "</p>"


@pytest.mark.parametrize("attributes", ['class="md:flex hidden lg:block"', 'class="overflow-x hidden md-block"', 'style="overflow: hidden "', 'data-x="a hidden b"', 'title="display:none"', 'class="has-comments with-ads"', 'class="no-ad"', 'aria-hidden="false"', 'hidden', 'class="single-comments"'])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_html_keeps_articles(tag, attributes):
    page = f"<body><div><a href=x>menu</a> <a href=y>more</a></div><{tag} {attributes}><h2>Title here</h2>{PROSE}<p title='the hidden gem'>The end.</p></{tag}></body>"
    text = html.main_text(page)
    assert "word59 and more text" in text and text.endswith("The end.")


@pytest.mark.parametrize("name", ["reader-comments", "user-comments", "article-comments", "blog-comments", "comment-body", "discussion", "ad-300x250", "ad-leaderboard", "google-ad", "advert-mpu", "dfp-ad", "cookie-law-info-bar", "thread", "readerComments"])
@pytest.mark.parametrize("wrap", ["article", "div"])
def test_html_drops_comments_and_adverts(wrap, name):
    inside = f"<body><{wrap}><h2>Title</h2>{PROSE}<div class='{name}'>{SHORT}</div><p>The end.</p></{wrap}></body>"
    beside = f"<body><{wrap}><h2>Title</h2>{PROSE}<p>The end.</p></{wrap}><div id='{name}'>{SHORT}{SHORT}</div></body>"
    for page in (inside, beside):
        text = html.main_text(page)
        assert "remark" not in text and "word59" in text and text.endswith("The end.")


def test_html_keeps_the_rest_of_an_article():
    """A name that says advert around nearly all of an article's text is not believed."""
    page = f"<body><article><h2>Title</h2><div class='article-ad'>{PROSE}</div></article></body>"
    assert "word59" in html.main_text(page)
    assert html.main_text(f"<body><article><p>Short but whole.</p>{PROSE}</article><div style='display: none'>{SHORT}</div></body>").count("remark") == 0


# -- stages return their documents' columns
@pytest.mark.parametrize("stage", ["toxicity", "simhash", "substring", "decontamination", "mixing"])
def test_stages_keep_columns(spark, stage):
    import corpus_pipeline

    rng = random.Random(41)
    texts = [prose(rng, 80) for _ in range(30)] + [None, "", "short one"]
    passage = prose(rng, 60)
    texts[3], texts[9] = f"{texts[3]} {passage}", f"{texts[9]} {passage}"
    names = ["score", "predicted", "n_words", "hit_spans", "size", "__h", "h", "a.b", "k_text", "k0", "id", "tag", "class", "node", "__i", "component_id", "fingerprint"]
    table = docs(spark, texts).select("doc_id", "text", "lang", "source", "n_chars", *(F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names))
    function = dict(corpus_pipeline.STAGES)[stage]
    if stage == "toxicity":
        out = toxicity.drop_toxic(table, (np.zeros(toxicity.MASK + 1), -1.0))
    elif stage == "decontamination":
        out = decontam.remove_contaminated(table, spark.createDataFrame([(1, prose(rng, 20))], "item_id long, text string"))
    else:
        out = function(spark, table, DATA)
    kept = [n for n in names if stage != "mixing" or n not in ("size",)]
    if stage != "mixing":
        assert out.columns == table.columns
    rows = out.collect()
    assert len({r.doc_id for r in rows}) >= 25
    for r in rows:
        assert all(r[n] == f"{n}:{r.doc_id}" for n in kept)


def test_spanning_forest():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(2, 30))
        pairs = np.array([(i, j) for i in range(n) for j in range(i) if rng.random() < 0.3], np.int64).reshape(-1, 2)
        rank = rng.permutation(len(pairs)).astype(np.int64)
        kept = simhash._spanning(pairs[:, 0], pairs[:, 1], rank, n)
        root = list(range(n))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        want = np.zeros(len(pairs), bool)
        for e in np.argsort(rank):
            a, b = find(pairs[e, 0]), find(pairs[e, 1])
            if a != b:
                root[a], want[e] = b, True
        assert (kept == want).all()
