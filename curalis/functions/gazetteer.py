"""Word lists of many thousands of names in the rewrite rules.

One alternation of all names costs a try of each at every place of a text.  For a list of more than ``LARGE`` names, an automaton
over the folded names (Aho-Corasick; no accents, lower case, blanks folded) reads each text once and lists the few names that can
occur in it; the rule then takes its pattern for that text from these alone.  A name that does not occur cannot match, so
the result is that of the whole alternation: same places, longest name first, accents and blanks as ``text.tolerant`` has them.

Rules see texts that earlier rules have rewritten.  What stands between placeholders is a stretch of the first text, and the words
in placeholders are looked up as well; names with brackets, which could reach over a placeholder's edge, are always listed.

The names are broadcast: lists of up to ``MAX_BYTES`` of text; a larger one is an error.  A worker builds an automaton once.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from array import array

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curalis.functions import text as X

LARGE = 500
MAX_BYTES = 64 << 20
#: What the rules put into a text, apart from brackets.
PLACEHOLDERS = "email documento telefono numero_id institucion medico fecha hora anio edad municipio mes año"
_BLANKS = re.compile(r"\s+")


class _Folding(dict):
    """For ``str.translate``: each character in lower case and without marks, as its letters compare in a pattern."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        up = c.upper() if len(c.upper()) == 1 else c
        low = up.lower()[0]
        self[point] = out = "".join(x for x in unicodedata.normalize("NFD", low) if unicodedata.category(x) != "Mn")
        return out


_FOLDING = _Folding()


def fold(text: str) -> str:
    return _BLANKS.sub(" ", text.translate(_FOLDING))


class Names:
    """Some lists in one automaton."""

    def __init__(self, lists: dict[str, list[str]]):
        self.lists = lists
        self.always: dict[str, list[int]] = {k: [] for k in lists}
        # The automaton holds one number for each folded name: its last entry, of which ``_before`` names the one before.
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self._keys, self._list, self._place, self._before = list(lists), array("b"), array("i"), array("i")
        for n, (key, names) in enumerate(lists.items()):
            for i, name in enumerate(names):
                folded = fold(name)
                if not folded.strip() or re.search(r"[\[\]<>:+-]", name):
                    self.always[key].append(i)
                else:
                    self._before.append(self.automaton.get(folded, -1))
                    self.automaton.add_word(folded, len(self._place))
                    self._list.append(n)
                    self._place.append(i)
        self.automaton.make_automaton()

    def found(self, text: str) -> dict[str, list[str]]:
        """Names of each list that may match in the text or in what it becomes, longest first, then as listed."""
        seen = {k: set(v) for k, v in self.always.items()}
        if len(self.automaton):
            for part in (fold(text), PLACEHOLDERS_FOLDED):
                for _, entry in self.automaton.iter(part):
                    while entry >= 0:
                        seen[self._keys[self._list[entry]]].add(self._place[entry])
                        entry = self._before[entry]
        return {k: [self.lists[k][i] for i in sorted(v, key=lambda i, k=k: (-len(self.lists[k][i]), i))] for k, v in seen.items()}


PLACEHOLDERS_FOLDED = fold(PLACEHOLDERS)
_built: dict[str, Names] = {}


def large(lists: dict[str, list[str]]) -> dict[str, list[str]]:
    """The lists that are looked up by automaton."""
    return {k: v for k, v in lists.items() if isinstance(v, list) and len(v) > LARGE}


def finder(spark: SparkSession, lists: dict[str, list[str]], patterns: set[str]):
    """A column function: for a text, a struct with an array for each list, of patterns for the lists named in
    ``patterns`` and of the names themselves, in lower case, for the others."""
    size = sum(len(n.encode()) for names in lists.values() for n in names)
    if size > MAX_BYTES:
        raise ValueError(f"{size} bytes of names; lists of up to {MAX_BYTES} are broadcast")
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, lists))
    schema = ", ".join(f"{k} array<string>" for k in lists)

    @F.pandas_udf(schema)
    def found(texts: pd.Series) -> pd.DataFrame:
        key, names = shared.value
        if key not in _built:
            _built.clear()
            _built[key] = Names(names)
        rows = [_built[key].found(t or "") for t in texts]
        shown = {k: X.tolerant if k in patterns else str.lower for k in lists}
        return pd.DataFrame({k: [[shown[k](n) for n in r[k]] for r in rows] for k in lists}, columns=list(lists))

    return found


def alternation(names: Column, before: str, after: str) -> Column:
    """The pattern with any of the names, or null if there is none."""
    return F.when(F.size(names) > 0, F.concat(F.lit(f"{before}(?:"), F.array_join(names, "|"), F.lit(f"){after}")))


def names_of(table: DataFrame, column: str) -> list[str]:
    """The distinct names of a table in a fixed order, if they are within ``MAX_BYTES``."""
    names = table.select(F.col(column).alias("n")).where("n is not null").distinct()
    size = names.agg(F.sum(F.octet_length("n"))).first()[0] or 0
    if size > MAX_BYTES:
        raise ValueError(f"{size} bytes of names; lists of up to {MAX_BYTES} are broadcast")
    return sorted(r["n"] for r in names.collect())
