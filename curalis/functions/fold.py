"""Rewriting with a decision for each match, as one native expression.

Matches are marked, the text is split at the marks (odd parts are
matches), and a fold over the parts decides, rewrites and logs.  A match that is kept is consumed all
the same.  Positions count characters of the text as the rule found it.

The marks are two of the noncharacters that Unicode sets aside for such internal use and that no text may
exchange; should a text hold them all the same, they are removed.  All other characters, those of the private
use areas too, are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK, INNER = "\ufdd0", "\ufdd1"
LOG = "array<struct<rule:string,original:string,placeholder:string,start:int,token:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without_marks(text: Column) -> Column:
    return F.when(text.contains(MARK) | text.contains(INNER), F.translate(text, MARK + INNER, "")).otherwise(text)


def marked(text: Column, pattern: str | Column, groups: int = 0) -> Column:
    inner = "".join(f"{INNER}${g}" for g in range(1, groups + 1))
    return F.regexp_replace(text, F.lit(pattern), F.lit(f"{MARK}$0{inner}{MARK}"))


def parts(text: Column, pattern: str | Column, groups: int = 0) -> Column:
    return F.split(marked(text, pattern, groups), MARK, -1)


def holds(text: Column, pattern: str | Column) -> Column:
    """Whether the pattern, which may be a null column, is found."""
    return text.rlike(pattern) if isinstance(pattern, str) else F.coalesce(F.rlike(text, pattern), F.lit(False))


def state(text: Column) -> Column:
    return F.struct(without_marks(text).alias("text"), F.array().cast(LOG).alias("log"))


def rewrite(now: Column, rule: str, pattern: str | Column, decide: Callable[[list[Column], Column], Column], groups: int = 0) -> Column:
    """``rewritten`` of an expression that is computed once."""
    return let(now, lambda s: rewritten(s, rule, pattern, decide, groups))


def rewritten(s: Column, rule: str, pattern: str | Column, decide: Callable[[list[Column], Column], Column], groups: int = 0, *needs: str | None) -> Column:
    """The state after ``s``: ``decide([match, group 1, ...], position)`` gives the placeholder, or null to keep.
    Kept matches with a group are logged without a placeholder.  ``needs`` are plainer patterns that every match holds;
    only texts that have them are searched.  A match is taken apart and decided once."""

    # A part with groups is taken apart once, before the fold; without groups it is the match.
    first = (lambda part: F.get(part, F.lit(0))) if groups else (lambda part: part)

    def step(acc: Column, part: Column) -> Column:
        match, odd = first(part), acc["i"] % 2 == 1
        found = [match, *(F.get(part, F.lit(g)) for g in range(1, groups + 1))]
        token = found[1] if groups else F.lit(None).cast("string")

        def noted(to: Column) -> Column:
            entry = F.array(F.struct(F.lit(rule).alias("rule"), match.alias("original"), to.alias("placeholder"), acc["pos"].alias("start"), token.alias("token")))
            return F.struct(
                (acc["i"] + 1).alias("i"),
                (acc["pos"] + F.length(match)).alias("pos"),
                F.concat(acc["out"], F.coalesce(to, match)).alias("out"),
                (F.concat(acc["log"], entry) if groups else F.when(to.isNotNull(), F.concat(acc["log"], entry)).otherwise(acc["log"])).alias("log"),
            )

        kept = F.struct((acc["i"] + 1).alias("i"), (acc["pos"] + F.length(match)).alias("pos"), F.concat(acc["out"], match).alias("out"), acc["log"].alias("log"))
        return F.when(odd, let(decide(found, acc["pos"]).cast("string"), noted)).otherwise(kept)

    def folded(marked: Column) -> Column:
        cut = F.split(marked, MARK, -1)
        cut = F.transform(cut, lambda part: F.split(part, INNER, -1)) if groups else cut
        zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("pos"), F.lit("").alias("out"), s["log"].alias("log"))
        return F.aggregate(cut, zero, step, lambda a: F.struct(a["out"].alias("text"), a["log"].alias("log")))

    # The pattern is searched once: a text without a mark after that had no match.
    done = let(marked(s["text"], pattern, groups), lambda m: F.when(m.contains(MARK), folded(m)).otherwise(s))
    tests = [] if isinstance(pattern, str) else [pattern.isNotNull()]
    tests += [s["text"].contains(n) if n == re.sub(r"\W(?<!@)", "", n) else s["text"].rlike(n) for n in needs if n]
    return F.when(reduce(and_, tests), done).otherwise(s) if tests else done


def spans(text: Column, pattern: str) -> Column:
    """Begin and end of each match."""

    def step(acc: Column, part: Column) -> Column:
        end = acc["pos"] + F.length(part)
        here = F.array(F.struct(acc["pos"].alias("a"), end.alias("b"), part.alias("match")))
        return F.struct((acc["i"] + 1).alias("i"), end.alias("pos"), F.when(acc["i"] % 2 == 1, F.concat(acc["found"], here)).otherwise(acc["found"]).alias("found"))

    empty = F.array().cast("array<struct<a:int,b:int,match:string>>")
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("pos"), empty.alias("found"))
    return F.when(text.rlike(pattern), F.aggregate(parts(text, pattern), zero, step, lambda a: a["found"])).otherwise(empty)
