"""Conversation structure repair by dynamic programming over turns.

A conversation is right if the initials of its roles are ``(s?(ua)+)?``.  Each row is kept, given another role or deleted,
turns without text may be inserted, and the cheapest edits win; among equally cheap ones the audit (initials of the edits:
``D``, ``I``, ``K``, ``R``) that is least in ASCII.  Blank and duplicate rows must go, truncated ones cost if they stay.

Conversations of a run of rows are put into buckets by length (powers of two).  A bucket is one NumPy tensor, time
first: going backward, the costs of the four states of all its conversations are updated turn by turn and stored; going
forward, the edits of all conversations are read off the stored costs turn by turn.  At most one role is right in each
state, so an edit leads to one state and the forward choice of the least letter is exact.

Two passes over the rows, each dealt by conversation and sorted: the first sees narrow rows only (turn, initial, faults,
digest of role and text) and gives the audits; the second meets each audit and then the texts as a stream, and keeps none.
The rows of one conversation pass one task in order, since its audit and its hash are single values: the first pass holds
some 250 bytes for each of its rows while it is solved, the second only the audit.  No other conversation waits in memory with it.

Nulls: a null role or text is one space (so the row is blank), a null turn comes first, rows with a null id are a conversation
of their own whose id is null.  Ties: rows of one turn are taken in the order of role, then of the MD5 of role and text.
Repeated rows are duplicates.  An empty text is blank, an empty role has no legal initial.  Texts of any length are read whole.
A conversation without (present) rows has zeros, an empty audit and the hash of the empty string; an empty table gives
an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A

#: Rows that are solved together, but for a longer conversation.
RUN = 100_000
NEVER = 1 << 40
#: States by what stands last: nothing, system, user, assistant; the role that may follow each besides ``system`` at first.
START, SYSTEM, USER, ASSISTANT = range(4)
WANTED = np.array([USER, USER, ASSISTANT, USER])
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = [(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)]
#: Faults of a row; PAD fills tensors beyond a conversation's end.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
PAD = 16
SPACES = r"[\x20\x09-\x0D]"


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs of deleting (by code), keeping and giving the wanted role (by code and state); a code is 4 * fault + initial."""
        delete = np.full(PAD + 1, self.delete)
        delete[PAD] = 0
        keep, rerole = np.full((PAD + 1, 4), NEVER), np.full((PAD + 1, 4), NEVER)
        for fault, more in ((NONE, 0), (TRUNCATED, self.truncated)):
            for initial in range(4):
                rerole[4 * fault + initial] = self.rerole + more
                for state in range(4):
                    if initial and (initial == WANTED[state] or (state, initial) == (START, SYSTEM)):
                        keep[4 * fault + initial, state] = self.keep + more
        return delete, keep, rerole

    def __post_init__(self):
        if self.insert <= 0 or min(self.keep, self.rerole, self.delete, self.truncated) < 0:
            raise ValueError("costs are not negative, and inserting costs something")


def solve(codes: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a tensor of codes ``[time, conversation]``: least costs, the letter of each row (0 at the padding) and the
    number of turns inserted before each row and at the end."""
    turns, many = codes.shape
    delete, keep, rerole = costs.tables()
    stay = np.arange(4)
    back = np.empty((turns + 1, many, 4), np.int64)

    def with_inserts(b):
        for _ in range(3):  # no state is met twice, as inserting costs something
            b = np.minimum(b, costs.insert + b[:, WANTED])
        return b

    back[turns] = with_inserts(np.where(np.isin(stay, (START, ASSISTANT)), 0, NEVER)[None, :].repeat(many, 0))
    for t in range(turns - 1, -1, -1):
        code, after = codes[t], back[t + 1]
        initial = np.where(code == PAD, 0, code % 4)
        kept = keep[code] + np.take_along_axis(after, initial[:, None], 1)
        back[t] = with_inserts(np.minimum(np.minimum(delete[code][:, None] + after, kept), rerole[code] + after[:, WANTED]))
    letters, inserted = np.zeros((turns, many), np.uint8), np.zeros((turns + 1, many), np.int64)
    state, every = np.zeros(many, np.int64), np.arange(many)
    for t in range(turns + 1):
        while True:
            now = back[t, every, state]
            gone = delete[codes[t]] + back[t + 1, every, state] == now if t < turns else now == 0
            more = ~gone & (costs.insert + back[t, every, WANTED[state]] == now)
            if not more.any():
                break
            inserted[t] += more
            state = np.where(more, WANTED[state], state)
        if t < turns:
            code = codes[t]
            initial = np.where(code == PAD, 0, code % 4)
            kept = ~gone & (keep[code, state] + back[t + 1, every, initial] == now)
            letters[t] = np.where(gone, np.where(code == PAD, 0, ord("D")), np.where(kept, ord("K"), ord("R")))
            state = np.where(gone, state, np.where(kept, initial, WANTED[state]))
    return back[0, :, START], letters, inserted


def audits(codes: np.ndarray, lengths: np.ndarray, costs: Costs) -> tuple[np.ndarray, list[str]]:
    """Least cost and audit of each conversation, given the codes of all rows and the rows of each."""
    total, found = np.zeros(len(lengths), np.int64), [""] * len(lengths)
    first = np.cumsum(lengths) - lengths
    bucket = np.ceil(np.log2(np.maximum(lengths, 1))).astype(int)
    for b in np.unique(bucket[lengths > 0]):
        here = np.flatnonzero((bucket == b) & (lengths > 0))
        n = lengths[here]
        tensor = np.full((int(n.max()), len(here)), PAD)
        conv = np.repeat(np.arange(len(here)), n)
        time = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        tensor[time, conv] = codes[first[here][conv] + time]
        total[here], letters, inserted = solve(tensor, costs)
        turns = len(tensor)
        chars, counts = np.full((len(here), 2 * turns + 1), ord("I"), np.uint8), np.empty((len(here), 2 * turns + 1), np.int64)
        chars[:, 1::2], counts[:, 1::2], counts[:, 0::2] = letters.T, (letters > 0).T, inserted.T
        line, ends = np.repeat(chars.ravel(), counts.ravel()).tobytes().decode(), np.cumsum(counts.sum(1))
        for i, a, e in zip(here.tolist(), (ends - counts.sum(1)).tolist(), ends.tolist(), strict=True):
            found[i] = line[a:e]
    return total, found


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str, present: Column) -> DataFrame:
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role, text))
    id_ = F.col(f"`{conv}`")
    return turns.select(
        F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("")).alias("key"),
        id_.alias("id"),
        present.alias("present"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        text.alias("text"),
    )


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _groups(batches, size: int):
    """Tables of ``size`` rows or more (but for the last) that hold all rows of their keys."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            table = pa.Table.from_batches(held)
            keys = table.column("key").combine_chunks()
            differ = np.flatnonzero(np.asarray(pc.not_equal(keys[1:], keys[:-1])))
            if len(differ):
                cut = int(differ[-1]) + 1
                yield table.slice(0, cut)
                held, n = table.slice(cut).to_batches(), table.num_rows - cut
    if n:
        yield pa.Table.from_batches(held)


def _audit(table: pa.Table, costs: Costs) -> pa.Table:
    """One row for each key of narrow rows that stand in order."""
    keys = table.column("key").combine_chunks()
    start = np.concatenate([[True], np.asarray(pc.not_equal(keys[1:], keys[:-1]))]) if len(keys) > 1 else np.ones(1, bool)
    first, owner = np.flatnonzero(start), np.cumsum(start) - 1
    many = len(first)
    column = lambda name: table.column(name).combine_chunks()
    here = np.asarray(column("present"))
    conv, initial, blank, ended = owner[here], *(np.asarray(column(c))[here] for c in ("initial", "blank", "ended"))
    digest = np.frombuffer(b"".join(column("digest").to_pylist()), ">u8").reshape(-1, 2)[here]
    place = np.arange(len(conv))
    order = np.lexsort((place, digest[:, 1], digest[:, 0], conv))
    again = np.zeros(len(conv), bool)
    again[order[1:]] = (conv[order[1:]] == conv[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]]).all(1)
    fault = np.where(blank, BLANK, np.where(again, DUPLICATE, np.where(ended, NONE, TRUNCATED)))
    lengths = np.bincount(conv, minlength=many)
    cost, audit = audits(4 * fault + initial, lengths, costs)
    number = lambda mask: np.bincount(conv[mask], minlength=many)
    same = conv[1:] == conv[:-1]
    legal = np.zeros((4, 4), bool)
    for pair in LEGAL:
        legal[pair] = True
    illegal = np.bincount(conv[1:][same & ~legal[initial[:-1], initial[1:]]], minlength=many)
    turn, dated = np.asarray(column("turn").fill_null(0))[here], np.asarray(column("turn").is_valid())[here]
    turn, when = turn[dated], conv[dated]
    gaps = np.zeros(many, np.int64)
    if len(turn):
        new = np.concatenate([[True], (when[1:] != when[:-1]) | (turn[1:] != turn[:-1])])
        begin = np.flatnonzero(np.concatenate([[True], when[1:] != when[:-1]]))
        end = np.append(begin[1:], len(when)) - 1
        gaps[when[begin]] = turn[end] - turn[begin] + 1 - np.bincount(when[new], minlength=many)[when[begin]]
    made = [gaps, number(fault == BLANK), number(fault == DUPLICATE), number(fault == TRUNCATED), illegal, cost]
    ids = table.select(["key", "id"]).take(pa.array(first))
    columns = {"key": ids.column("key"), "id": ids.column("id"), **{n: pa.array(x, pa.int64()) for n, x in zip(COUNTS, made, strict=True)}, "audit": pa.array(audit, pa.string())}
    return pa.table(columns)


def _sorted(df: DataFrame) -> DataFrame:
    order = [c for c in ("key", "kind", "turn", "role", "digest") if c in df.columns]
    return df.repartition("key").sortWithinPartitions(*(F.asc_nulls_first(c) for c in order))


def _audited(rows: DataFrame, costs: Costs) -> DataFrame:
    last = F.substring(F.regexp_replace("text", rf"{SPACES}+\z", ""), -1, 1)
    initial = F.coalesce(*(F.when(F.left("role", F.lit(1)) == c, F.lit(n)) for c, n in INITIALS.items()), F.lit(0))
    narrow = rows.select("key", "id", "present", "turn", "role", "digest", initial.alias("initial"), (last == "").alias("blank"), last.isin(".", "!", "?").alias("ended"))
    schema = T.StructType([rows.schema["key"], rows.schema["id"], *(T.StructField(n, T.LongType()) for n in COUNTS), T.StructField("audit", T.StringType())])
    target = A.to_arrow_schema(schema)

    def run(batches):
        for table in _groups(batches, RUN):
            yield from _audit(table, costs).cast(target).combine_chunks().to_batches()

    return _sorted(narrow).mapInArrow(run, schema)


class _Walk:
    """The turns of one repaired conversation, as its rows come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self):
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = int(WANTED[self.state])
            yield ROLES[self.state], ""

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = INITIALS[role[0]]
            yield role, text
        elif edit == "R":
            self.state = int(WANTED[self.state])
            yield ROLES[self.state], text


def _meet(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Each audit, then the texts of its conversation in order."""
    texts = rows.where("present").select("key", F.lit(1).alias("kind"), "turn", "role", "digest", "text", *(F.lit(None).cast(audited.schema[c].dataType).alias(c) for c in audited.columns[1:]))
    heads = audited.select("key", F.lit(0).alias("kind"), *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "digest", "text")), *audited.columns[1:])
    return _sorted(heads.unionAll(texts))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None, costs: Costs = Costs()) -> DataFrame:
    """One row for each conversation: its id, ``gaps, blank, duplicate, truncated, illegal, cost, audit`` and
    ``repaired_sha256`` of the repaired turns as ``role:text``, joined by line ends.  Rows that are not ``present`` only name theirs."""
    rows = _rows(turns, conv, turn, role, text, F.lit(True) if present is None else present)
    audited = _audited(rows, costs)
    added = [*COUNTS, "audit", "repaired_sha256"]
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *audited.schema[2:], T.StructField("repaired_sha256", T.StringType())])
    target = A.to_arrow_schema(schema)

    def run(batches):
        now, begun = None, False

        def close():
            for r, t in walk.inserted():
                put(r, t)
            return {**now, "repaired_sha256": digest.hexdigest()}

        def put(r, t):
            nonlocal begun
            digest.update((("\n" if begun else "") + f"{r}:{t}").encode())
            begun = True

        for batch in batches:
            out = []
            kinds, roles, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("kind", "role", "text"))
            heads = batch.select(["id", *COUNTS, "audit"])
            for i, kind in enumerate(kinds.to_pylist()):
                if kind == 0:
                    if now is not None:
                        out.append(close())
                    now = heads.slice(i, 1).to_pylist()[0]
                    walk, digest, begun = _Walk(now["audit"]), hashlib.sha256(), False
                else:
                    for r, t in walk.row(roles[i].as_py(), texts[i].as_py()):
                        put(r, t)
            if out:
                yield pa.RecordBatch.from_pylist(out, target)
        if now is not None:
            yield pa.RecordBatch.from_pylist([close()], target)

    return _meet(rows, audited).mapInArrow(run, schema).select(F.col("id").alias(conv), *added)


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", costs: Costs = Costs()) -> DataFrame:
    """The repaired turns themselves: the conversation's id, place (from 0), role and text."""
    rows = _rows(turns, conv, turn, role, text, F.lit(True))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    target = A.to_arrow_schema(schema)

    def run(batches):
        now, walk, place = None, None, 0
        for batch in batches:
            out = []

            def put(r, t):
                nonlocal place
                out.append({"id": now, "place": place, "role": r, "text": t})
                place += 1

            for x in batch.select(["kind", "id", "audit", "role", "text"]).to_pylist():
                if x["kind"] == 0:
                    for turn_ in walk.inserted() if walk else ():
                        put(*turn_)
                    now, walk, place = x["id"], _Walk(x["audit"]), 0
                else:
                    for turn_ in walk.row(x["role"], x["text"]):
                        put(*turn_)
            if out:
                yield pa.RecordBatch.from_pylist(out, target)
        out = []
        if walk:
            for n, (r, t) in enumerate(walk.inserted()):
                out.append({"id": now, "place": place + n, "role": r, "text": t})
        if out:
            yield pa.RecordBatch.from_pylist(out, target)

    return _meet(rows, _audited(rows, costs)).mapInArrow(run, schema).select(F.col("id").alias(conv), "place", "role", "text")


def damaged(conversations: DataFrame) -> DataFrame:
    """The table with faults that depend on a checksum of id and turn; ``present`` is false for rows that were dropped."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))), F.lit(20))
    text = F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    rows = conversations.select("conv_id", "turn", "role", "text", fault.alias("f"))
    rows = rows.select("conv_id", "turn", F.when(F.col("f") == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"), "f")
    copies = F.when(F.col("f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", (F.col("f") != 0).alias("present"), F.explode(copies).alias("copy"))


def op12(spark, sf_dir):
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), present=F.col("present"))
