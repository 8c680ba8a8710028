"""Cleaning, keys, redaction, expansion and labels on Arrow batches of texts.

Each kernel gives what the column expressions of ``text``, ``operators.redact`` and ``operators.enrich`` give.  Most texts have
no match of most patterns; so each pattern has a sieve, a pattern without look-around that RE2 tries on a whole batch at the
cost of one pass over its bytes, and only texts that pass it are searched by the pattern itself.  A sieve lets every text pass in which the
pattern is found.  That is shown for texts of characters up to U+00FF; others are always searched.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from curalis.functions import fold
from curalis.functions import text as X
from curalis.functions import values as V

TEXT = pa.large_string()
#: Members of RE2 classes: white space, what may be a character of a word, and what surely is one.
_SPACE, _MAY_WORD, _WORD = r" \t-\r\x1c-\x1f\x{85}\x{a0}", r"0-9A-Za-z_\x{80}-\x{10ffff}", r"0-9A-Za-z_\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}"
_MEMBERS = {"s": _SPACE, "w": _MAY_WORD, "d": "0-9"}


def compiled(pattern: str) -> re.Pattern:
    """A pattern of the rules; classes of characters are Unicode's here without a flag."""
    return re.compile(re.sub(r"^\(\?(i?)U\)", lambda m: "(?i)" if m[1] else "", pattern))


def texts_of(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(TEXT), "")


def _closing(p: str, i: int) -> int:
    """The place after the group that opens at ``i``."""
    depth = 0
    while True:
        if p[i] == "\\":
            i += 1
        elif p[i] == "[":
            i = p.index("]", i + 2)
        else:
            depth += (p[i] == "(") - (p[i] == ")")
            if not depth:
                return i + 1
        i += 1


def sieve(pattern: str, bounded: bool = True) -> str | None:
    """A pattern for RE2 that is found in each text, of characters up to U+00FF, in which ``pattern`` is found: look-around goes, and borders of words
    but for those at both ends if what stands there are characters of words (``bounded``)."""
    flags, p = re.fullmatch(r"(\(\?i?U?\))?(.*)", pattern, re.S).groups()
    out, i = [], 0
    if p.isascii() or max(p) <= "\xff":
        while i < len(p):
            if p.startswith(("(?!", "(?=", "(?<!", "(?<="), i):
                i = _closing(p, i)
            elif p[i] == "[":
                end = p.index("]", i + 2) + 1
                out.append(re.sub(r"\\([swd])", lambda m: _MEMBERS[m[1]], p[i:end]))
                i = end
            elif p.startswith("\\b", i):
                if bounded and i == 0:
                    out.append(f"(?:^|[^{_WORD}])")
                elif bounded and i == len(p) - 2 and p[i - 1] != "+":
                    out.append(f"(?:[^{_WORD}]|$)")
                i += 2
            elif p[i] == "\\":
                out.append(f"[{_MEMBERS[p[i + 1]]}]" if p[i + 1] in _MEMBERS else p[i : i + 2])
                i += 2
            else:
                out.append(p[i])
                i += 1
        made = ("(?i)" if flags and "i" in flags else "") + "".join(out)
        try:
            pc.match_substring_regex(pa.array([""]), made)
            return made
        except pa.ArrowInvalid:
            pass
    return None


def _found(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(bool)


def _wide(texts: pa.Array) -> np.ndarray:
    """Texts with characters beyond U+00FF."""
    return _found(texts, r"[^\x{0}-\x{ff}]")


def _passed(texts: pa.Array, through: str | None, wide: np.ndarray) -> np.ndarray:
    return np.arange(len(texts)) if through is None else np.flatnonzero(_found(texts, through) | wide)


def _replaced(texts: pa.Array, at: list[int] | np.ndarray, new: list[str]) -> pa.Array:
    if not len(at):
        return texts
    mask = np.zeros(len(texts), bool)
    mask[at] = True
    return pc.replace_with_mask(texts, pa.array(mask), pa.array(new, TEXT))


def _each(texts: pa.Array, at: np.ndarray, make: Callable[[str], str]) -> pa.Array:
    return _replaced(texts, at, [make(t) for t in texts.take(pa.array(at)).to_pylist()]) if len(at) else texts


# Cleaning ------------------------------------------------------------------------------------------
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
_UNTIDY = rf"[^\x{{0}}-\x{{ff}}]|{_CONTROL}|^[{_SPACE}]|[{_SPACE}]$|\.{{4}}|[ \t]\n|\n[ \t]|\n\n\n|  |[\t\x{{a0}}]|[{_SPACE}][,;:.]|[,;:][^{_SPACE}0-9]"
_ARTEFACTS = r"""|"|^[0-9']+[A-ZÁÉÍÓÚÑ]{3}"""
_STEPS = [(re.compile(p), to) for p, to in ((r"\.{4,}", "..."), (r"[ \t]*\n[ \t]*", "\n"), (r"\n{3,}", "\n\n"), (X.BLANKS, " "), (r"\s+([,;:.])", r"\1"), (r"([,;:])(?=[^\s\d])", r"\1 "))]
_control, _quotes, _begin, _lone = map(re.compile, (_CONTROL, '"{2,}', r"""^\s*[\d"']+(?=[A-ZÁÉÍÓÚÑ]{3,})""", r'(?<!\w)"(?!\w)'))


def _clean(t: str, exported: bool) -> str:
    t = unicodedata.normalize("NFC", _control.sub(" ", t))
    if exported:
        t = _begin.sub("", _quotes.sub('"', t)).strip(X.SPACE).strip('"')
    t = t.strip(X.SPACE)
    if exported:
        t = _lone.sub("", t)
    for pattern, to in _STEPS:
        t = pattern.sub(to, t)
    return t.strip(X.SPACE)


def cleaned(column: pa.Array, exported: bool) -> pa.Array:
    """``text.clean``.  One pass finds the texts that any step changes."""
    texts = texts_of(column)
    return _each(texts, np.flatnonzero(_found(texts, _UNTIDY + (_ARTEFACTS if exported else ""))), lambda t: _clean(t, exported))


# Keys ----------------------------------------------------------------------------------------------
_BARE = dict(zip(map(ord, X.UNICODE.marked), [*X.UNICODE.bare, *[None] * (len(X.UNICODE.marked) - len(X.UNICODE.bare))], strict=True)) | dict.fromkeys(range(0x300, 0x370))


def unaccented(t: str) -> str:
    return t if t.isascii() else t.translate(_BARE)


#: Keys of the characters up to U+00FF; in the second table each kind of white space is a blank.
_KEY = bytes(ord(unaccented(chr(c)).lower()) for c in range(256))
_LABEL = bytes(32 if chr(c) in X.SPACE else k for c, k in enumerate(_KEY))
_blanks, _spaces, _many = re.compile(X.BLANKS), re.compile(rf"[{X.SPACE}]+"), re.compile(b"  +")


def match_key(t: str) -> str:
    try:
        k = t.encode("latin-1").translate(_KEY).decode("latin-1")
    except UnicodeEncodeError:
        k = unicodedata.normalize("NFC", unaccented(t)).lower()
    if "  " in k or "\t" in k or not k.isascii():
        k = _blanks.sub(" ", k)
    return k.strip(X.SPACE)


def label_key(t: str) -> str:
    try:
        k = t.encode("latin-1").translate(_LABEL)
    except UnicodeEncodeError:
        return _spaces.sub(" ", unaccented(t).lower()).strip(X.SPACE)
    return (_many.sub(b" ", k) if b"  " in k else k).strip(b" ").decode("latin-1")


def match_keys(column: pa.Array) -> pa.Array:
    return pa.array([None if t is None else match_key(t) for t in column.to_pylist()], pa.string())


_words = re.compile(r"\s+")
_FUNCTION_WORDS = frozenset(V.FUNCTION_WORDS)
#: A text that ends in one of them, each letter with all that have its key.
_ENDS_OPEN = rf"(?:^|[{_SPACE}])[,;:-]*(?:{'|'.join(''.join('[' + ''.join(chr(i) for i, k in enumerate(_KEY) if k == ord(c)) + ']' for c in w) for w in V.FUNCTION_WORDS)})[,;:-]*$"


def ends_open(column: pa.Array) -> pa.Array:
    """Whether the last word of each clean text is one that no sentence ends in."""
    texts = texts_of(column)
    out = np.zeros(len(texts), bool)
    at = np.flatnonzero(_found(texts, _ENDS_OPEN) | _wide(texts))
    for i, t in zip(at.tolist(), texts.take(pa.array(at)).to_pylist(), strict=True):
        out[i] = match_key(_words.split(t[t.rfind(" ") + 1 :])[-1]).strip(",;:-") in _FUNCTION_WORDS
    return pa.array(out)


# Redaction -----------------------------------------------------------------------------------------
def age_band(value: int, unit: str) -> str:
    unit = unaccented(unit).lower()
    if unit.startswith("dia"):
        return "[EDAD:<1 mes]"
    if unit.startswith("mes") or value < 1:
        return "[EDAD:<1 año]"
    if value >= 90:
        return "[EDAD:90+]"
    low, width = (value // 5 * 5, 4) if value < 18 else (value // 10 * 10, 9)
    return f"[EDAD:{low}-{low + width}]"


def _known(words: list[str]):
    known = frozenset(w.lower() for w in words)
    return lambda m: unaccented(m[1]).lower() in known


def lowered(pattern: str) -> re.Pattern | None:
    """For a pattern that ignores case and has no capitals but in classes: one that finds the same in the lower case of texts of characters up to
    U+00FF, each of which has one such character for its lower case.  To ignore case takes several times as long.  Patterns
    that begin with what must not stand before a digit look for the digit first."""
    if not pattern.startswith("(?iU)") or max(pattern) > "\xff":
        return None
    p = pattern.removeprefix("(?iU)")
    return re.compile(rf"(?=\d){p}" if p.startswith("(?<!") and re.match(r"(?:\\b)?\(?(?:\?:)?(?:\\d|\[?[0-9])", p[_closing(p, 0) :]) else p)


class Rule:
    """A rewrite rule: ``decide`` gives a match's placeholder from match and text, or none to keep it."""

    def __init__(self, name: str, pattern: str, decide: str | Callable, groups: int, bounded: bool = True):
        self.name, self.groups = name, groups
        self.pattern, self.lower = compiled(pattern), lowered(pattern)
        self.decide = decide if callable(decide) else lambda m, text: decide
        self.sieve = sieve(pattern, bounded)

    def search(self, text: str, wide: bool = True):
        return self.lower.finditer(text.lower()) if self.lower and not wide else self.pattern.finditer(text)

    def rewritten(self, text: str, note: Callable, wide: bool = True) -> str:
        out, end = [], 0
        for m in self.search(text, wide):
            to = self.decide(m, text)
            a, b = m.span()
            if to is not None:
                out += (text[end:a], to)
                end = b
            if self.groups or to is not None:
                note((text[a:b], to, a, text[m.start(1) : m.end(1)] if self.groups else None))
        return "".join((*out, text[end:])) if out else text


def _places(lists: dict[str, list[str]]):
    # What is found in lower case must hold the letters that stand in the pattern.
    needed = lambda p: X.literal(p) if re.fullmatch(r"(?:[^\\(\[]|\\[sbdw])*", p) else ""
    excepted = [(compiled(f"(?iU){p}"), needed(p)) for p in lists["municipios_excepciones"]]

    def decide(m: re.Match, text: str) -> str | None:
        at, every = m.start(), m.re.flags & re.I
        return None if any(s.start() <= at < s.end() for p, letters in excepted if every or letters in m.string for s in p.finditer(text)) else "[MUNICIPIO]"

    return decide


@cache
def rules(lists_json: str) -> list[Rule]:
    """The rules of ``operators.redact`` in their order."""
    from curalis.operators import redact

    lists = json.loads(lists_json)
    bounded = lambda name: all(re.fullmatch(r"[^\W_](?s:.*[^\W_])?", n) for n in lists[name])
    generic = compiled(redact.any_name(lists, "tipos_genericos", rf"{redact.I}^{V.INSTITUTION}\s+", r"\s*$", None)) if lists["tipos_genericos"] else None
    after_type = redact.any_name(lists, "instituciones", rf"{redact.I}{V.INSTITUTION}{V.FILLER}\s+", r"\b", None) if lists["instituciones"] else None
    generic_hospital, listed_doctor = _known(lists["hospital_genericos"]), _known(lists["medicos"])
    fixed = {"email": "[EMAIL]", "documento": "[DOCUMENTO]", "telefono": "[TELEFONO]", "numero_id": "[NUMERO_ID]", "institucion": "[INSTITUCION]"}
    fixed |= {"institucion_santoral": "[INSTITUCION]", "institucion_sigla": "[INSTITUCION]", "fecha": "[FECHA]", "hora": "[HORA]", "anio": "[ANIO]"}
    fixed["institucion_hospital"] = lambda m, text: None if generic_hospital(m) else "[INSTITUCION]"
    fixed["medico"] = lambda m, text: "[MEDICO]" if listed_doctor(m) else None
    # What stands before the number stays; before the suffix nothing does.
    fixed["edad"] = lambda m, text: text[m.start() : m.start(1)] + age_band(int(m[1]), m[2])
    ends = {"institucion": bounded("instituciones") and bounded("instituciones_sin_trigger"), "institucion_sigla": bounded("instituciones_siglas")}
    out = []
    for name, rule in redact.rules(lists):
        pattern, _, groups, *_ = rule(None)
        decide = fixed[name]
        if generic and pattern == after_type:
            decide = lambda m, text: None if generic.search(m[0]) else "[INSTITUCION]"
        out.append(Rule(name, pattern, decide, groups, ends.get(name, True)))
    if lists["municipios"]:
        out.append(Rule("municipio", redact.any_name(lists, "municipios", rf"{redact.I}\b", r"\b", None), _places(lists), 0, bounded("municipios")))
    return out


def _without_marks(texts: pa.Array) -> pa.Array:
    gone = dict.fromkeys(map(ord, fold.MARK + fold.INNER))
    return _each(texts, np.flatnonzero(_found(texts, f"[{fold.MARK}{fold.INNER}]")), lambda t: t.translate(gone))


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def redacted(columns: list[pa.Array], fields: list[str], lists_json: str) -> tuple[list[pa.Array], pa.ListArray]:
    """The texts of some columns, rewritten, and the log of each row in the order of fields, rules and places."""
    n, k = len(columns[0]), len(columns)
    texts = _without_marks(pa.concat_arrays(map(texts_of, columns)))
    wide = _wide(texts)
    where, which, events = [], [], []
    made = rules(lists_json)
    for r, rule in enumerate(made):
        at = _passed(texts, rule.sieve, wide)
        if not len(at):
            continue
        changed, new = [], []
        for i, text in zip(at.tolist(), texts.take(pa.array(at)).to_pylist(), strict=True):
            before = len(events)
            after = rule.rewritten(text, events.append, wide[i])
            if after is not text:
                changed.append(i)
                new.append(after)
            if len(events) > before:
                where += [i] * (len(events) - before)
                which += [r] * (len(events) - before)
        texts = _replaced(texts, changed, new)
    where, which = np.array(where, np.int64), np.array(which, np.int32)
    row, field = where % max(n, 1), where // max(n, 1)
    order = np.argsort(row * k + field, kind="stable")
    original, placeholder, start, token = zip(*events, strict=True) if events else ((),) * 4
    pick = lambda values, of: pa.array(values, pa.string()).take(pa.array(of))
    log = pa.StructArray.from_arrays(
        [
            pick(fields, field[order]),
            pick([rule.name for rule in made], which[order]),
            pick(original, order),
            pick(placeholder, order),
            pa.array(start, pa.int32()).take(pa.array(order)),
            pick(token, order),
        ],
        ["campo", "regla", "original", "placeholder", "inicio", "token"],
    )
    return [texts.slice(f * n, n).cast(pa.string()) for f in range(k)], _lists(np.bincount(row, minlength=n), log)


# Expansion -----------------------------------------------------------------------------------------
@cache
def _abbreviations(table_json: str):
    table = json.loads(table_json)
    pattern = rf"(?iU)\b{X.one_of(list(table), re.escape, re.escape)}\b"
    # Keys of letters and digits stand between borders of words where a word is one of them.
    words = re.compile(r"\w+") if all(re.fullmatch("[a-z0-9]+", a) for a in table) else None
    return {a.lower(): b for a, b in table.items()}, compiled(pattern), words, sieve(pattern, all(re.fullmatch(r"[^\W_](?s:.*[^\W_])?", a) for a in table))


def expanded(columns: list[pa.Array], table_json: str) -> tuple[list[pa.Array], pa.ListArray]:
    """``enrich.expand`` of some columns, and the sorted keys found in any."""
    n = len(columns[0])
    # Nulls stay.
    whole = pa.concat_arrays([c.cast(TEXT) for c in columns])
    texts = _without_marks(texts_of(whole))
    table, pattern, words, through = _abbreviations(table_json)
    found: dict[int, set[str]] = {}
    changed, new = [], []
    wide = _wide(texts)
    at = _passed(texts, through, wide) if table else np.arange(0)
    for i, text in zip(at.tolist(), texts.take(pa.array(at)).to_pylist(), strict=True):
        seen, out, end = set(), [], 0
        for m in pattern.finditer(text) if wide[i] or not words else (m for m in words.finditer(text.lower()) if m[0] in table):
            key = m[0].lower()
            if key not in seen:
                seen.add(key)
                if key in table:
                    out += (text[end : m.end()], f" ({table[key]})")
                    end = m.end()
        if seen:
            found.setdefault(i % n, set()).update(seen)
        if out:
            changed.append(i)
            new.append("".join((*out, text[end:])))
    texts = _replaced(texts, changed, new)
    texts = pc.if_else(whole.is_valid(), texts, pa.scalar(None, TEXT)) if whole.null_count else texts
    counts, keys = np.zeros(n, np.int64), []
    for i in sorted(found):
        counts[i] = len(found[i])
        keys += sorted(found[i])
    return [texts.slice(f * n, n).cast(pa.string()) for f in range(len(columns))], _lists(counts, pa.array(keys, pa.string()))


# Labels --------------------------------------------------------------------------------------------
class Label:
    """The patterns of a label for keys of ``label_key``.  RE2 finds them all in ASCII keys, but for those with a look-around."""

    def __init__(self, patterns: list[str]):
        # Keys have no accents, and single spaces for white space.
        patterns = [re.sub(r"\[([a-z])[áéíóúñü]\]", r"\1", p).replace(r"\s+", " ") for p in patterns]
        around = [p for p in patterns if re.search(r"\(\?<?[!=]", p)]
        self.search, self.around = re.compile("|".join(patterns)).search, around and sieve("|".join(around))
        self.plain = "|".join(p for p in patterns if p not in around and p.isascii())

    def found(self, keys: pa.Array, other: np.ndarray) -> np.ndarray:
        out = _found(keys, self.plain) & ~other
        rest = other | (_found(keys, self.around) & ~out) if self.around else other
        at = np.flatnonzero(rest)
        if len(at):
            out[at] = [self.search(k) is not None for k in keys.take(pa.array(at)).to_pylist()]
        return out


@cache
def _labels(kind: str) -> dict[str, Label]:
    return {label: Label(patterns) for label, patterns in getattr(V, kind).items()}


def _not_ascii(keys: pa.Array) -> np.ndarray:
    return ~pc.string_is_ascii(keys).to_numpy(zero_copy_only=False).astype(bool)


def _first(keys: pa.Array, kind: str) -> np.ndarray:
    """The number of the first label found in each key, or that of no label."""
    labels = list(_labels(kind).values())
    out, left = np.full(len(keys), len(labels)), np.arange(len(keys))
    for n, label in enumerate(labels):
        hit = label.found(keys, _not_ascii(keys))
        if hit.any():
            out[left[hit]] = n
            left, keys = left[~hit], keys.filter(pa.array(~hit))
    return out


def _named(numbers: np.ndarray, kind: str) -> pa.Array:
    return pa.array([*getattr(V, kind), V.UNKNOWN], pa.string()).take(pa.array(numbers))


def labelled(reason: pa.Array, exam: pa.Array, stay: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Mechanism, regions and outcome of ``enrich.classify``."""
    fields = [texts_of(c).to_pylist() for c in (reason, exam, stay)]
    one, rest = [label_key(r) for r in fields[0]], [label_key(f"{e} {s}") for e, s in zip(*fields[1:], strict=True)]
    both = pa.array([f"{a} {b}" for a, b in zip(one, rest, strict=True)], TEXT)
    keys = pa.array(rest, TEXT)
    none = len(V.MECHANISMS)
    mechanism = _first(pa.array(one, TEXT), "MECHANISMS")
    at = np.flatnonzero(mechanism == none)
    mechanism[at] = _first(both.take(pa.array(at)), "MECHANISMS")
    other = _not_ascii(both)
    table = np.stack([label.found(both, other) for label in _labels("REGIONS").values()], axis=1)
    names = pa.array(list(V.REGIONS), pa.string()).take(pa.array(np.nonzero(table)[1]))
    return _named(mechanism, "MECHANISMS"), _lists(table.sum(axis=1), names), _named(_first(keys, "OUTCOMES"), "OUTCOMES")
