"""Quality rules as a short-circuit cascade (numbered operator 6).

The rules look at one text each. Their cost (measured seconds a text) and selectivity (share of texts they
reject) are estimated on a bounded sample, and the cascade runs them in the order of rejections per
cost: a text that one rule rejects is not handed to the next. The rules are joined by AND, so the verdict
does not depend on the order; only the work does. Shared measures are computed when a rule first asks
for them.

Defined results: null and empty texts have no words and are rejected by the base rule; repeated rows are judged
alike; other columns pass through untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.llm import textkit as K

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _distinct_earlier(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """True where the same (row, key) stands at a smaller index."""
    order = np.lexsort((np.arange(len(key)), key, row))
    same = np.zeros(len(key), bool)
    same[1:] = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    out = np.zeros(len(key), bool)
    out[order] = same
    return out


class Texts:
    """Lazily measured texts of one chunk."""

    def __init__(self, column: pa.Array):
        self.column = column
        self.w = K.words(column, K.SPACE_WORD, lower=False)
        self.n = self.w.n_rows
        self._known: dict[str, np.ndarray] = {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._known:
            self._known[name] = getattr(self, f"_{name}")()
        return self._known[name]

    def _per_row(self, flag: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flag)))
        return total[bounds[1:]] - total[bounds[:-1]]

    def _n_words(self):
        return np.diff(self.w.first)

    def _word_chars(self):
        # every byte of a word that does not continue a UTF-8 character starts a code point
        return self._per_row(K.SPACE_WORD[self.w.buf] & ((self.w.buf & 0xC0) != 0x80), self.w.bounds)

    def _n_symbols(self):
        return self._per_row(_SYMBOL[self.w.buf], self.w.bounds)

    def _alpha_words(self):
        buf = self.w.buf
        letter = ((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 128)
        total = np.concatenate(([0], np.cumsum(letter)))
        return self._per_row(total[self.w.end] > total[self.w.start], self.w.first)

    def _lines(self):
        """(row, line hash) of the lines with a word."""
        buf, bounds = self.w.buf, self.w.bounds
        breaks = np.flatnonzero(buf == 10)
        row_start = bounds[:-1]
        per_row = np.ones(self.n, np.int64) + self._per_row(buf == 10, bounds)
        row = np.repeat(np.arange(self.n), per_row)
        lo = np.concatenate([[0], np.cumsum(per_row)])
        start = np.empty(lo[-1], np.int64)
        end = np.empty(lo[-1], np.int64)
        start[lo[:-1]] = row_start
        end[lo[1:] - 1] = bounds[1:]
        inner = np.ones(lo[-1], bool)
        inner[lo[:-1]] = False
        start[inner] = breaks + 1
        last = np.ones(lo[-1], bool)
        last[lo[1:] - 1] = False
        end[last] = breaks
        full = np.searchsorted(self.w.start, end) > np.searchsorted(self.w.start, start)
        return row[full], K.span_hashes(buf, start[full], end[full])

    def _line_count(self):
        return np.bincount(self["lines"][0], minlength=self.n).astype(np.int64)

    def _n_dup_lines(self):
        row, h = self["lines"]
        return np.bincount(row[_distinct_earlier(row, h)], minlength=self.n).astype(np.int64)

    def _n_repeat_words(self):
        g, ok = self.w.grams(3)
        row = self.w.row_of_word()
        at = np.flatnonzero(ok)
        order = at[np.lexsort((g[at], row[at]))]
        same = (g[order][1:] == g[order][:-1]) & (row[order][1:] == row[order][:-1])
        many = np.zeros(len(order), bool)
        many[1:] |= same
        many[:-1] |= same
        hit = np.zeros(len(g) + 3, bool)
        for k in range(3):
            hit[order[many] + k] = True
        return self._per_row(hit[:len(g)], self.w.first)


@dataclass(frozen=True)
class Rule:
    """``rejects(texts, rows)`` gives a flag for each of ``rows``; cost and share come from the sample."""

    name: str
    rejects: Callable[[Texts, np.ndarray], np.ndarray]
    cost: float = 0.0
    share: float = 0.0


def _ratio(part: str, whole: str, over: float) -> Callable:
    return lambda t, rows: t[part][rows] > over * t[whole][rows]


#: Production rules: loose bounds, for texts that are clearly not prose.
RULES = (
    Rule("long_words", lambda t, r: t["word_chars"][r] > 25 * t["n_words"][r]),
    Rule("symbols", _ratio("n_symbols", "n_words", 0.5)),
    Rule("few_letters", lambda t, r: 2 * t["alpha_words"][r] < t["n_words"][r]),
    Rule("repeated_lines", lambda t, r: t["n_dup_lines"][r] > 0.5 * np.maximum(1, t["line_count"][r])),
)


def base_failed(t: Texts) -> np.ndarray:
    return (t["n_words"] < 50) | (100 * t["n_repeat_words"] > 50 * t["n_words"])


def cascade(t: Texts, rules, rows: np.ndarray) -> np.ndarray:
    """The rows that no rule rejects; each rule sees only what the earlier ones left. Once fewer than half of
    the texts stand, they are taken apart, so later measures are computed for them alone."""
    at = rows
    for rule in rules:
        if not len(rows):
            break
        if 2 * len(at) < t.n:
            t, at = Texts(t.column.take(pa.array(at))), np.arange(len(at))
        stays = ~rule.rejects(t, at)
        rows, at = rows[stays], at[stays]
    return rows


def ordered_rules(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = 2000, sample_bytes: int = 8 << 20) -> list[Rule]:
    """Rules by rejections per second, measured on a sample of at most ``sample_rows`` texts and about ``sample_bytes`` characters
    (documented bounds: they decide the order of work, never a verdict). A uniform fraction of the rows, taken by
    a hash of the text, not the first ones."""
    total = docs.count()
    if not total:
        return list(rules)
    bucket = F.pmod(F.xxhash64(K.text_column(docs, text)), F.lit(max(1, total // sample_rows)))
    sample = docs.filter(bucket == 0).select(K.text_column(docs, text)).limit(sample_rows)
    taken, size = [], 0
    for r in sample.toLocalIterator():
        taken.append(r[0])
        size += len(r[0] or "")
        if size >= sample_bytes:
            break
    column = pa.array(taken, pa.string())
    if not len(column):
        return list(rules)
    found = []
    for rule in rules:
        t = Texts(column)  # afresh: a rule pays for the measures it needs
        began = time.perf_counter()
        share = float(np.mean(rule.rejects(t, np.arange(t.n))))
        found.append(replace(rule, cost=(time.perf_counter() - began) / t.n, share=share))
    return sorted(found, key=lambda r: (-r.share / max(r.cost, 1e-9), r.name))


def judge(docs: DataFrame, rules=None, text: str = "text", prefix: str = "", measures: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with ``base_failed``, ``kept`` and, if asked for, the measures (their names take ``prefix``).
    Columns of ``docs`` with those names are replaced. Without ``measures`` a text that a rule rejects is measured no further."""
    plan = [r.name for r in (rules or ordered_rules(docs, text=text))]
    shown = MEASURES if measures else ()
    new = [prefix + c for c in (*shown, "base_failed", "kept")]
    carried = docs.drop(*new)
    named = {r.name: r for r in (rules or RULES)}
    schema = T.StructType(carried.schema.fields + [T.StructField(prefix + c, T.LongType()) for c in shown]
                          + [T.StructField(prefix + c, T.BooleanType()) for c in ("base_failed", "kept")])

    def run(batches):
        rules_here = [named[n] for n in plan]
        for batch in batches:
            for part in K.chunks(batch, text):
                t = Texts(part.column(text))
                failed = base_failed(t)
                kept = np.zeros(t.n, bool)
                kept[cascade(t, rules_here, np.flatnonzero(~failed))] = True
                cols = [t[c].astype(np.int64) for c in shown] + [failed, kept]
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, cols)], names=[*part.schema.names, *new])

    return carried.mapInArrow(K.handing_back(run), schema)
