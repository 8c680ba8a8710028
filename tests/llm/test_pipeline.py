"""The stages on the smallest tables: columns, and what goes and stays."""

import random
from collections import Counter

import corpus_pipeline
from curalis.llm import decontam, queries
from tests.conftest import DATA
from tests.llm.test_operators import prose, water


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids, name
        assert len(now) == docs.count() or k == len(corpus_pipeline.STAGES) - 1, name
        assert docs.columns[: len(columns)] == columns
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        ids = now
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert decontam.find_contamination(docs, bench).where("size(hit_spans) > 0").count() == 0
    assert len(ids) > 100


def test_run_equals_stages_and_takes_empty(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert max(Counter(r.doc_id for r in rows).values()) == 2
    empty = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, DATA)
    assert empty.count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def test_stages_by_brute_force(spark, tmp_path):
    """Planted copies, passages, leaks and toxic documents: what each stage keeps is recomputed without Spark."""
    rng = random.Random(60)
    passage, item = prose(rng, 60), prose(rng, 15)
    rows = []
    for i in range(240):
        text = prose(rng, rng.randint(60, 160))
        if i % 6 == 1:
            words = text.split()
            words[rng.randrange(len(words))] = rng.choice(["zqidiot", "zqclown"])
            words[rng.randrange(len(words))] = "zqscum"
            text = " ".join(words)
        elif i % 8 == 2:
            text = f"{text} {passage} {prose(rng, 40)}"
        elif i % 24 == 4:
            text = f"{text} {item}"
        elif i % 12 == 5:
            text = rows[i - 5][1]
        rows.append((i, text, "en", f"s{i % 4}" if i % 9 else None, len(text)))
    toxic = {i for i, *_ in rows if i % 6 == 1}
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    texts = {i: t for i, t, *_ in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = {r.doc_id: r.text for r in stage(spark, docs, str(tmp_path)).collect()}
        if name == "toxicity":
            want = {i: t for i, t in texts.items() if i not in toxic}
        elif name == "simhash":
            grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
            want = {}
            for i, t in texts.items():
                if all(len(grams[i] & grams[j]) < 0.5 * len(grams[i] | grams[j]) for j in want):
                    want[i] = t
        elif name == "substring":
            first, want = {}, {}
            for i, t in texts.items():
                w = t.split()
                gone = set()
                for k in range(len(w) - 49):
                    if first.setdefault(tuple(w[k : k + 50]), i) < i:
                        gone |= set(range(k, k + 50))
                want[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
        else:
            w = item.split()
            windows = [" ".join(w[k : k + 10]) for k in range(len(w) - 9)]
            want = {i: t for i, t in texts.items() if not any(x in t for x in windows)}
        differ = {i: (len(t.split()), len(want.get(i, "").split())) for i, t in got.items() if " ".join(t.split()) != want.get(i)}
        # A passage that happens to go on for a word in some other pair of documents may keep that word (see README).
        assert all(name == "substring" and abs(a - b) <= 1 for a, b in differ.values()) and len(differ) <= 2 and len(got) == len(want), name
        assert len(want) < len(texts) or want != texts, name
        by_id = {i: (lang, source) for i, _, lang, source, _ in rows}
        docs = spark.createDataFrame([(i, t, *by_id[i], len(t)) for i, t in got.items()], docs.schema)
        texts = {i: " ".join(t.split()) for i, t in got.items()}
    size = {i: len(t.split()) for i, t in texts.items()}
    per = Counter()
    for i, n in size.items():
        per[by_id[i][1]] += n
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(per, key=lambda s: (s is None, s or "")))}
    target = water(per, weights, 1.5 * sum(per.values()))
    mixed = corpus_pipeline.mix(spark, docs, str(tmp_path)).collect()
    read = Counter()
    for r in mixed:
        assert (r.size, r.source_size) == (size[r.doc_id], per[r.source]) and r.words <= r.size
        read[r.source] += r.words
    assert all(abs(read[s] - target[s]) <= 1 for s in per)
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)
