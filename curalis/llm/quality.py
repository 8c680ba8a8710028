"""Learned decision lists over text statistics (DataFrame functions only on the rows).

Statistics are native expressions.  Labelled statistics of a bounded sample (``MAX_TRAIN`` rows,
chosen by a hash of the id) go to the driver, where sequential covering grows conjunctions of
thresholds on two thirds, prunes them on the rest, and emits one ordered CASE expression.

Growing stops when a rule is pure, has ``MAX_CONDITIONS`` conditions or gains nothing; covering stops when no
row of the class is left, after ``MAX_RULES`` rules, or when the best pruning of a new rule is worth at most
``WORTH`` = (right - wrong) / covered on the rows held back.  Thresholds are ``BINS`` quantiles of each statistic.
These bound the list's size, not the rows: it is applied to all of them.

Null and empty texts have zero statistics and are never kept.  Labels that are null are ignored;
without labels the list is empty and keeps what passes the base rules.  Of equally good tests the first is
taken, so reruns agree.  Texts of any length are judged whole.  Repeated rows are judged alike.  An empty
table gives an empty result.  Added columns replace their namesakes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 20_000
MAX_RULES = 16
MAX_CONDITIONS = 4
BINS = 24
WORTH = 0.2
SPACE = r"[\x20\x09-\x0D]+"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice.  Windows are compared by 64-bit hash."""
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1), x + 3) - x)), F.lit(0), lambda a, b: a + b
        )

    def same(s: Column) -> Column:
        found = F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))
        return let(F.sort_array(F.transform(found, lambda e: e["i"])), covered)

    return let(F.sort_array(windows), same)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def statistics(text: str) -> dict[str, Column]:
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _repeated(w).cast("long").alias("n_repeat_words"),
        )

    return {
        "__w": let(words, of),
        "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": _dup_lines(t).cast("long"),
        "n_shouts": F.regexp_count(t, F.lit("[!?]")).cast("long"),
        "n_upper": F.regexp_count(t, F.lit("[A-Z]{2,}")).cast("long"),
    }


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    made = docs.select(*(F.col(f"`{c}`").alias(f"k_{c}") for c in keep), *(c.alias(n) for n, c in statistics(text).items()))
    names = ("n_words", "word_chars", "n_repeat_words")
    return made.select(*(f"k_{c}" for c in keep), *(F.col("__w")[n].alias(n) for n in names), "n_symbols", "n_dup_lines", "n_shouts", "n_upper")


def features() -> dict[str, Column]:
    """What conditions compare: counts and rates of the statistics."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "f_words": F.col("n_words").cast("double"),
        "f_word_len": F.col("word_chars") / n,
        "f_symbols": F.col("n_symbols") / n,
        "f_dup_lines": F.col("n_dup_lines").cast("double"),
        "f_dup_rate": F.col("n_dup_lines") / n,
        "f_repeats": F.col("n_repeat_words") / n,
        "f_shouts": F.col("n_shouts") / n,
        "f_upper": F.col("n_upper") / n,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def cover(x: np.ndarray, y: np.ndarray) -> list[tuple[list[tuple[int, bool, float]], int]]:
    """Ordered rules ``([(feature, above, threshold)], class)`` by sequential covering; the last, without
    conditions, is the default."""
    default = int(2 * y.sum() >= len(y)) if len(y) else 1
    target = 1 - default
    tests, masks = [], []
    for f in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 2)[1:-1])) if len(x) else []
        values = np.unique(x[:, f]) if len(x) else np.zeros(0)
        for c in cuts:
            up = values[values > c]
            c = float((c + up[0]) / 2) if len(up) else float(c)
            for above in (True, False):
                tests.append((f, above, c))
                masks.append((x[:, f] > c) if above else (x[:, f] <= c))
    rules: list[tuple[list, int]] = []
    if tests:
        table = np.array(masks)
        grow = np.random.default_rng(1).permutation(len(y)) % 3 != 2
        hit, left = y == target, np.ones(len(y), bool)
        while len(rules) < MAX_RULES and (left & hit & grow).any():
            inside, chosen = left & grow, []
            while len(chosen) < MAX_CONDITIONS and (inside & ~hit).any():
                p0, n0 = (inside & hit).sum(), (inside & ~hit).sum()
                p, n = (table & (inside & hit)).sum(1), (table & (inside & ~hit)).sum(1)
                gain = np.where(p > 0, p * (np.log2((p + 1e-9) / (p + n + 1e-9)) - np.log2(p0 / (p0 + n0))), 0)
                best = int(np.argmax(gain))
                if gain[best] <= 1e-9:
                    break
                chosen.append(best)
                inside &= table[best]
            held, worth = left & ~grow, []
            for k in range(1, len(chosen) + 1):
                m = held & table[chosen[:k]].all(0)
                p, n = (m & hit).sum(), (m & ~hit).sum()
                worth.append(((p - n) / max(p + n, 1), -k))
            if not worth or max(worth)[0] <= WORTH:
                break
            chosen = chosen[: -max(worth)[1]]
            rules.append(([tests[i] for i in chosen], target))
            left &= ~table[chosen].all(0)
    return [*rules, ([], default)]


def verdict(rules) -> Column:
    """The rules as one CASE expression; true: keep."""
    names, out = list(features()), None
    for conditions, label in rules:
        if not conditions:
            return out.otherwise(bool(label)) if out is not None else F.lit(bool(label))
        test = F.lit(True)
        for f, above, c in conditions:
            test = test & ((F.col(names[f]) > c) if above else (F.col(names[f]) <= c))
        out = F.when(test, bool(label)) if out is None else out.when(test, bool(label))
    return out


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", max_train: int = MAX_TRAIN):
    """A decision list from at most ``max_train`` labelled rows that pass the base rules."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__y"))
    known = known.orderBy(F.xxhash64("__id"), "__id", "__y").limit(max_train)  # at most max_train pairs of numbers: small enough to broadcast
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__t")).join(F.broadcast(known), "__id").select("__id", "__y", "__t")
    stats = with_statistics(texts, "__t", ["__id", "__y"])
    # The base rules are applied here: as a filter they would be evaluated for all documents before the join.
    rows = stats.select("k___id", "k___y", *(c.alias(n) for n, c in features().items()), base_failed()).limit(2 * max_train).collect()
    rows = sorted(r for r in rows if not r[-1])
    width = len(features())
    x = np.array([[r[2 + i] for i in range(width)] for r in rows], float).reshape(len(rows), width)
    return cover(x, np.array([r[1] for r in rows], int))


def judge(docs: DataFrame, rules, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with the statistics, ``base_failed`` and ``kept``."""
    added = [*STATS, "base_failed", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    stats = with_statistics(docs, text, keep).withColumns({"base_failed": base_failed(), **features()})
    return stats.withColumn("kept", ~F.col("base_failed") & verdict(rules)).select(*(F.col(f"`k_{c}`").alias(c) for c in keep), *added)


def op10(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, rules, keep=["doc_id"])
