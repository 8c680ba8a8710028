"""Column functions on text: cleaning, matching keys, accent-tolerant patterns, age bands."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from curalis.functions import values as V

#: Planes that hold all characters with a canonical decomposition or a combining class.
_POINTS = [*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0100, 0xE01F0)]
#: A mark between parts while a text is composed; ``clean`` has replaced all control characters before.
CUT = "\x01"
#: Fillers of decompositions shorter than the longest, and the characters that write a combining class.
NOTHING, CLASS = "\x02", 0x4E00
HANGUL, LEAD, VOWEL, TRAIL = 0xAC00, 0x1100, 0x1161, 0x11A7


def _class(points: list[int]) -> str:
    """A character class of code points.  Java tries the members of a class one after another; so ranges are halved, each half
    behind the range that it spans, and a character meets as many tests as the tree is deep: below the first point, one."""
    points, ranges = sorted(points), []
    for p in points:
        if ranges and p == ranges[-1][1] + 1:
            ranges[-1][1] = p
        elif not ranges or p > ranges[-1][1]:
            ranges.append([p, p])

    def tree(part: list[list[int]]) -> str:
        span = f"\\x{{{part[0][0]:x}}}-\\x{{{part[-1][1]:x}}}"
        half = len(part) // 2
        return f"[{span}&&[{tree(part[:half])}{tree(part[half:])}]]" if half else f"[{span}]"

    return tree(ranges)


class _Unicode:
    """What canonical composition needs, drawn from Python's tables, each as one string."""

    def __init__(self):
        nfd, nfc = (lambda c: unicodedata.normalize("NFD", c)), (lambda c: unicodedata.normalize("NFC", c))
        marks = [p for p in _POINTS if unicodedata.combining(chr(p))]
        apart = {p: d for p in _POINTS if (d := nfd(chr(p))) != chr(p)}
        pairs = {}
        for p, d in apart.items():
            direct = unicodedata.decomposition(chr(p)).split()
            if len(direct) == 2 and nfc(chr(p)) == chr(p):
                pairs["".join(chr(int(x, 16)) for x in direct)] = chr(p)
        second = {ord(x[1]) for x in pairs}
        # What may change what stands before it, and what is never left alone.
        joins = {*marks, *second, *(p for p, d in apart.items() if unicodedata.combining(d[0])), *range(VOWEL, VOWEL + 21), *range(TRAIL + 1, TRAIL + 28)}
        changed = [p for p in apart if nfc(chr(p)) != chr(p)]
        self.needed = _class([*joins, *changed])
        # The negation stands before the class, as Java reads one inside a class with && in its own way.
        self.cluster = f"(?:(?!{_class([*joins])})[\\s\\S])?{_class([*joins])}+|{_class(changed)}"
        self.marks, self.classes = "".join(map(chr, marks)), "".join(chr(CLASS + unicodedata.combining(chr(p))) for p in marks)
        self.apart = "".join(map(chr, apart))
        longest = max(map(len, apart.values()))
        self.places = ["".join((d + NOTHING * longest)[i] for d in apart.values()) for i in range(longest)]
        self.pairs = "\x04".join(f"{k}\x03{v}" for k, v in pairs.items())
        # Without the marks of U+0300 to U+036F; what is nothing without them stands at the end, to be deleted.
        bare = {p: nfc("".join(x for x in d if not "\u0300" <= x <= "\u036f")) for p, d in apart.items()}
        bare = {p: b for p, b in bare.items() if len(b) < 2 and b != chr(p)}
        order = sorted(bare, key=lambda p: bare[p] == "")
        self.marked, self.bare = "".join(map(chr, order)), "".join(bare[p] for p in order)


UNICODE = _Unicode()
BLANKS = "[ \\t\u00a0\u2007\u202f]+"
#: The characters of ``(?U)\\s``.
SPACE = "\t\n\x0b\x0c\r \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def sub(text: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(to))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(SPACE))


def _where(there, pattern: str, to: str):
    """``sub`` only where ``there`` holds for the text, which it does for each text that has a match: to look for a few bytes
    takes far less than to write a text anew."""
    return lambda t: F.when(there(t), sub(t, pattern, to)).otherwise(t)


def _in_turn(text: Column, *steps) -> Column:
    """The text after some steps, each of which sees the one before computed once."""
    for step in steps:
        text = _let(text, step)
    return text


def _has(*some: str):
    return lambda t: reduce(or_, (t.contains(x) for x in some))


def _plain(text: Column) -> Column:
    """Whether all characters are of one byte, so none has a mark and none joins another."""
    return F.octet_length(text) == F.length(text)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _character(point: Column) -> Column:
    """The character of a code point of three bytes."""
    p = point.cast("int")
    number = (F.lit(0xE0) + F.shiftright(p, 12)) * 65536 + (F.lit(0x80) + F.shiftright(p, 6) % 64) * 256 + F.lit(0x80) + p % 64
    return F.decode(F.unhex(F.hex(number)), "UTF-8")


def _apart(c: Column) -> Column:
    """The full canonical decomposition of a character."""
    u = UNICODE
    parts = F.translate(F.concat(*(F.translate(c, u.apart, p) for p in u.places)), NOTHING, "")
    s = F.ascii(c) - HANGUL
    rest = s % 28
    jamo = F.concat(_character(LEAD + F.floor(s / 588)), _character(VOWEL + F.floor((s % 588) / 28)), F.when(rest > 0, _character(TRAIL + rest)).otherwise(""))
    return F.when(F.translate(c, u.apart, u.places[0]) != c, parts).when((s >= 0) & (s < 11172), jamo).otherwise(c)


def _joined(pair: Column) -> Column:
    """The character that two compose to, or null."""
    a, b = F.ascii(pair), F.ascii(F.substring(pair, 2, 1))
    lead, vowel, trail = a - LEAD, b - VOWEL, b - TRAIL
    syllable = F.when((lead >= 0) & (lead < 19) & (vowel >= 0) & (vowel < 21), _character(HANGUL + (lead * 21 + vowel) * 28))
    syllable = syllable.when((a >= HANGUL) & (a < HANGUL + 11172) & ((a - HANGUL) % 28 == 0) & (trail > 0) & (trail < 28), _character(a + trail))
    return F.coalesce(F.try_element_at(F.str_to_map(F.lit(UNICODE.pairs), F.lit("\x04"), F.lit("\x03")), pair), syllable)


def _composed(cluster: Column) -> Column:
    """The canonical composition of a few characters: taken apart, ordered by combining class between starters, joined."""
    chars = F.split(F.array_join(F.transform(F.split(cluster, ""), _apart), ""), "")

    def note(acc: Column, c: Column) -> Column:
        written = F.translate(c, UNICODE.marks, UNICODE.classes)
        rank = F.when(written != c, F.ascii(written) - CLASS).otherwise(0)
        block = acc["block"] + (rank == 0).cast("int")
        row = F.struct(block.alias("block"), rank.alias("rank"), F.size(acc["rows"]).alias("i"), c.alias("c"))
        return F.struct(block.alias("block"), F.array_append(acc["rows"], row).alias("rows"))

    def join(acc: Column, x: Column) -> Column:
        blocked = (acc["rest"] != "") & ((acc["last"] >= x["rank"]) | (x["rank"] == 0))
        # A starter that follows marks, or a mark that follows one of its own class or a greater, is not joined.
        return _let(F.when((acc["first"] != "") & ~blocked, _joined(F.concat(acc["first"], x["c"]))), lambda made: F.struct(
            F.when(made.isNull() & (x["rank"] == 0), F.concat(acc["out"], acc["first"], acc["rest"])).otherwise(acc["out"]).alias("out"),
            F.when(made.isNotNull(), made).when(x["rank"] == 0, x["c"]).otherwise(acc["first"]).alias("first"),
            F.when(made.isNotNull(), acc["rest"]).when(x["rank"] == 0, F.lit("")).otherwise(F.concat(acc["rest"], x["c"])).alias("rest"),
            F.when(made.isNotNull(), acc["last"]).otherwise(x["rank"]).alias("last"),
        ))

    empty = F.array().cast("array<struct<block:int,rank:int,i:int,c:string>>")
    rows = F.aggregate(chars, F.struct(F.lit(0).alias("block"), empty.alias("rows")), note, lambda a: F.array_sort(a["rows"]))
    zero = F.struct(F.lit("").alias("out"), F.lit("").alias("first"), F.lit("").alias("rest"), F.lit(0).alias("last"))
    return F.aggregate(rows, zero, join, lambda a: F.concat(a["out"], a["first"], a["rest"]))


def compose(text: Column) -> Column:
    """Canonical composition (NFC) of a text without the control character ``CUT``.  Only texts with a character that may join
    another, or never stands in composed text, are taken apart, and of these only such characters and what they follow."""
    cut = F.split(F.regexp_replace(text, F.lit(UNICODE.cluster), F.lit(f"{CUT}$0{CUT}")), CUT, -1)
    done = F.array_join(F.transform(cut, lambda x: F.when(x.rlike(UNICODE.needed), _composed(x)).otherwise(x)), "")
    return F.when(~_plain(text) & text.rlike(UNICODE.needed), done).otherwise(text)


def unaccent(text: Column) -> Column:
    """Without the marks of U+0300 to U+036F, alone or in a letter."""
    bare = F.translate(sub(text, r"[\u0300-\u036f]", ""), UNICODE.marked, UNICODE.bare)
    return F.when(_plain(text), text).otherwise(bare)


def clean(value: Column, exported: bool = True) -> Column:
    """Structural cleaning of a free-text field; null gives the empty string.  Quotes that a CSV export doubled or left over, and
    digits run into the capitals that begin a field, are its artefacts; in texts that were not ``exported`` they are kept."""
    # No control character joins another, so these may go first.
    t = sub(F.coalesce(value.cast("string"), F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")
    quoted = _has('"')
    first = [_where(_has('""'), r'"{2,}', '"'), lambda t: sub(t, r"""(?U)^\s*[\d"']+(?=[A-ZÁÉÍÓÚÑ]{3,})""", ""), strip, _where(quoted, r'^"+|"+$', "")]
    return _in_turn(
        t,
        compose,
        *(first if exported else ()),
        strip,
        *([_where(quoted, r'(?U)(?<!\w)"(?!\w)', "")] if exported else ()),
        _where(_has("...."), r"\.{4,}", "..."),
        _where(_has("\n"), r"[ \t]*\n[ \t]*", "\n"),
        _where(_has("\n\n\n"), r"\n{3,}", "\n\n"),
        fold_blanks,
        _where(lambda t: t.rlike(r"(?U)\s[,;:.]"), r"(?U)\s+([,;:.])", "$1"),
        _where(_has(",", ";", ":"), r"(?U)([,;:])(?=[^\s\d])", "$1 "),
        strip,
    )


def fold_blanks(text: Column) -> Column:
    """Each run of blanks as one; only texts with more than single spaces are written anew."""
    return _where(_has("  ", "\t", "\u00a0", "\u2007", "\u202f"), BLANKS, " ")(text)


def match_key(text: Column) -> Column:
    """Lower case without accents, blanks folded; line ends stay."""
    return _in_turn(text, unaccent, compose, F.lower, fold_blanks, strip)


def label_key(text: Column) -> Column:
    """Lower case without accents, all white space folded."""
    spaced = _where(lambda t: t.rlike(r"(?U)[^\S ]|\s\s"), r"(?U)\s+", " ")
    return _in_turn(text, unaccent, F.lower, spaced, strip)


def _tolerant(c: str) -> str:
    return r"\s+" if c == " " else f"[{V.ACCENTS[c]}]" if c in V.ACCENTS else re.escape(c)


def tolerant(phrase: str) -> str:
    """A pattern for the phrase in which letters match with and without accents and blanks any white space."""
    return "".join(map(_tolerant, phrase.lower()))


def any_of(phrases: list[str], pattern=tolerant) -> str:
    """Longest first, so that the most specific phrase wins."""
    return "(?:" + "|".join(pattern(p) for p in sorted(phrases, key=len, reverse=True)) + ")"


def one_of(phrases: list[str], character=_tolerant, pattern=tolerant) -> str:
    """``any_of`` as a tree over the phrases' beginnings, each tried once and not with each phrase.  The same matches: patterns of
    different plain letters, digits and blanks have no character in common, so the phrases that match at one place are beginnings of
    each other, and the longest comes first.  Phrases with other characters are tried one by one."""
    if not all(re.fullmatch("[a-z0-9]+(?: [a-z0-9]+)*", p.lower()) for p in phrases):
        return any_of(phrases, pattern)
    root: dict = {}
    for p in phrases:
        node = root
        for c in p.lower():
            node = node.setdefault(c, {})
        node[""] = {}

    def written(node: dict) -> str:
        ways = [character(c) + written(after) for c, after in node.items() if c] + [""] * ("" in node)
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    # Java tries the beginnings one after another: some at a time stand behind a look at the first letter.
    letters = sorted(root)
    if len(letters) > 6:
        few = [letters[i : i + 4] for i in range(0, len(letters), 4)]
        return "(?:" + "|".join(f"(?=[{''.join(character(c).strip('[]') for c in some)}]){written({c: root[c] for c in some})}" for some in few) + ")"
    return f"(?:{written(root)})"


def literal(pattern: str) -> str:
    """The longest string of lower-case letters and spaces that every match of a pattern holds, from what stands outside groups and classes and
    has no quantifier; empty where a pattern has alternatives."""
    if "|" in pattern:
        return ""
    plain = re.sub(r"\([^()]*\)[?*+]?(?:\{[^}]*\})?", "#", pattern)
    plain = re.sub(r"(?:\[[^\]]*\]|\\.|[^\\])(?:[?*]|\{[^}]*\})|\[[^\]]*\]|\\.", "#", plain)
    return "" if "(" in plain else max(re.findall("[a-z ]*", plain), key=len)


def age_band(value: Column, unit: Column) -> Column:
    u = F.lower(unaccent(unit))
    low = F.when(value < 18, F.floor(value / 5) * 5).otherwise(F.floor(value / 10) * 10)
    width = F.when(value < 18, 4).otherwise(9)
    return (
        F.when(u.startswith("dia"), F.lit("[EDAD:<1 mes]"))
        .when(u.startswith("mes"), F.lit("[EDAD:<1 año]"))
        .when(value >= 90, F.lit("[EDAD:90+]"))
        .when(value < 1, F.lit("[EDAD:<1 año]"))
        .otherwise(F.concat(F.lit("[EDAD:"), low.cast("string"), F.lit("-"), (low + width).cast("string"), F.lit("]")))
    )


def mask_placeholders(text: Column) -> Column:
    return sub(text, r"\[[^\]]{0,120}\]", " XX ")


def mostly_upper(text: Column, share: float = 0.8) -> Column:
    # Runs and not single characters are taken out; capitals are counted in what is left.
    letters = sub(text, r"[^\p{L}]+", "")
    counts = _let(letters, lambda t: F.array(F.length(t), F.length(sub(t, r"[^\p{Lu}]+", ""))))
    return _let(counts, lambda n: F.when(n[0] > 0, n[1] / n[0] > share).otherwise(False))
