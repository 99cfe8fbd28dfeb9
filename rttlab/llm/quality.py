"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths (numpy, over whole Arrow batches)
find the n-grams that occur twice or more in a text; the verdict looks at the
share of characters that lie inside them, and inside repeated lines. Spans with
equal hashes are compared, so that a made-up collision counts as no repetition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as S

# The published repetition rules, largest shares of characters inside n-grams and lines that occurred before.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
MIN_WORDS = 50
BASE_NGRAM = 3
BASE_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

_WORDS, _LINES = S.Rolling(11), S.Rolling(12)
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True

FIELDS = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
          ("n_repeat_words", "long"), ("line_dup_chars", "long"), ("line_chars", "long")]


def ngram_columns(ngrams) -> list[str]:
    return [f"dup_chars_{n}" for n in ngrams]


def _line_spans(data: np.ndarray, offs: np.ndarray):
    """Starts, ends and rows of the lines (\\n-split, rows apart) that hold a word, in page order."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    edge = np.zeros(len(data) + 1, bool)
    edge[np.flatnonzero(data == 10) + 1] = True
    edge[offs] = True
    starts = np.flatnonzero(edge)
    ends = starts[1:].copy()
    starts = starts[:-1]
    ends -= data[ends - 1] == 10
    blank = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~S.IS_SPACE[data], out=blank[1:])
    has_word = blank[ends] > blank[starts]
    starts, ends = starts[has_word], ends[has_word]
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def measure_block(data: np.ndarray, offs: np.ndarray, ngrams=tuple(NGRAM_LIMITS)) -> dict[str, np.ndarray]:
    """All counts for each row of one block.

    ``dup_chars_n``: characters of words inside an n-gram that occurred earlier
    in the text (first occurrences don't count); ``line_dup_chars``: the same
    for whole lines.
    """
    rows = len(offs) - 1
    chars = np.zeros(len(data) + 1, np.int64)  # code points before each byte
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    ws, we, wofs = S.word_spans(data, offs)
    n_words = np.diff(wofs)
    word_len = chars[we] - chars[ws]
    row_of = np.repeat(np.arange(rows), n_words).astype(np.uint64)
    salt = S.mix(row_of + np.uint64(1))
    out = {"n_words": n_words, "word_chars": S.row_sums(word_len, wofs),
           "n_symbols": S.row_sums(_IS_SYMBOL[data], offs)}

    ls, le, lrow = _line_spans(data, offs)
    line_keys = _LINES.span(_LINES.of_bytes(data), ls, le) ^ S.mix(lrow.astype(np.uint64) + np.uint64(7))
    _, later = S.repeated(S.exact_groups(line_keys, data, ls, le - ls, lrow))
    line_len = chars[le] - chars[ls]
    out["n_dup_lines"] = np.bincount(lrow[later], minlength=rows)
    out["line_dup_chars"] = np.bincount(lrow[later], line_len[later], rows).astype(np.int64)
    out["line_chars"] = np.bincount(lrow, line_len, rows).astype(np.int64)

    words = S.exact_groups(_WORDS.span(_WORDS.of_bytes(data), ws, we), data, ws, we - ws)  # equal words, equal numbers
    grams = _LINES.of_items(S.mix(words.astype(np.uint64)))
    row_end = np.repeat(wofs[1:], n_words)
    at = np.arange(len(ws))
    for n in (BASE_NGRAM, *ngrams):
        whole = np.flatnonzero(at + n <= row_end)
        keys = _LINES.span(grams, whole, whole + n) ^ salt[whole]
        twice, later = S.repeated(S.exact_groups(keys, words, whole, n, row_of[whole]))
        if n == BASE_NGRAM:
            out["n_repeat_words"] = S.row_sums(S.covered(len(ws), whole[twice], n), wofs)
        if n in ngrams:
            again = S.covered(len(ws), whole[later], n)
            out[f"dup_chars_{n}"] = S.row_sums(np.where(again, word_len, 0), wofs)
    return out


def repetition_counts(docs: DataFrame, text: str = "text", ngrams=tuple(NGRAM_LIMITS)) -> DataFrame:
    """``docs`` with the counts of :func:`measure_block` added, one row per input row.

    A null or empty text has zero counts; other nulls pass through. Columns of
    the input that carry the name of a count are replaced by it. Repeated rows
    are measured each for itself, an empty table gives an empty table. Texts
    are whole: a very long one is a block of its own.
    """
    names = [n for n, _ in FIELDS] + ngram_columns(ngrams)
    keep = [c for c in docs.columns if c not in names]
    schema = docs.select(keep).schema
    for n in names:
        schema = schema.add(n, "long")
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = S.text_buffer(b.column(at))
            parts = [measure_block(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], ngrams) for i, j in S.blocks(offs)]
            cols = [pa.array(np.concatenate([p[n] for p in parts]).astype(np.int64)) if parts
                    else pa.array([], pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*keep, *names])

    return S.map_batches(docs.select(keep), run, schema)


def share_too_high(part: str, whole: str, limit: float):
    return (F.col(whole) > 0) & (F.col(part) > F.lit(limit) * F.col(whole))


def quality_rules(docs: DataFrame, text: str = "text", limits: dict[int, float] | None = None,
                  line_limit: float = LINE_LIMIT, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than half of the
    words inside three-word windows found twice or more. ``kept``: not
    base_failed, and the characters inside duplicated n-grams stay within the
    limit of every n-gram length, those in repeated lines within
    ``line_limit``. Null and empty texts fail the base rule.
    """
    limits = NGRAM_LIMITS if limits is None else limits
    out = repetition_counts(docs, text, tuple(limits))
    bad = share_too_high("line_dup_chars", "line_chars", line_limit)
    for n, share in limits.items():
        bad = bad | share_too_high(f"dup_chars_{n}", "word_chars", share)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~bad)


def op1_quality_rules(spark, sf: str) -> DataFrame:
    """Repetition coverage and verdict of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).drop("text")


ORACLE = {"op1_quality_rules": rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
words as (select r, w, i from (select r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w, unnest(range(1, 1 + len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))) as i from d)),
doc as (select r, list(w order by i) as w, count(*) as n_words, sum(length(w)) as word_chars from words group by r),
grams as (select r, k.n, i, array_to_string(w[i:i + k.n - 1], ' ') as g
          from (select r, w, unnest(range(1, n_words + 1)) as i, n_words from doc) cross join (values {", ".join(f"({n})" for n in (BASE_NGRAM, *NGRAM_LIMITS))}) k(n)
          where i + k.n - 1 <= n_words),
seen as (select r, n, i, row_number() over (partition by r, n, g order by i) as nth, count(*) over (partition by r, n, g) as c from grams),
inside as (select distinct s.r, s.n, s.i + o.k as i from seen s, range(0, {max(NGRAM_LIMITS)}) o(k)
           where o.k < s.n and case when s.n = {BASE_NGRAM} then s.c > 1 else s.nth > 1 end),
chars as (select x.r, x.n, count(*) as words, sum(length(w.w)) as chars from inside x join words w on w.r = x.r and w.i = x.i group by x.r, x.n),
ln as (select r, t, j, row_number() over (partition by r, t order by j) as nth
       from (select r, unnest(string_split(text, chr(10))) as t, unnest(range(1, 1 + len(string_split(text, chr(10))))) as j from d)
       where regexp_matches(t, '[^\x20\x09-\x0D]+')),
lines as (select r, count(*) filter (nth > 1) as n_dup_lines, coalesce(sum(length(t)) filter (nth > 1), 0) as line_dup_chars, sum(length(t)) as line_chars from ln group by r),
m as (select d.doc_id, coalesce(doc.n_words, 0) as n_words, coalesce(doc.word_chars, 0)::bigint as word_chars,
             len(regexp_extract_all(d.text, '[#*$%&|<>]')) as n_symbols, coalesce(l.n_dup_lines, 0) as n_dup_lines,
             coalesce(max(c.words) filter (c.n = {BASE_NGRAM}), 0) as n_repeat_words, coalesce(l.line_dup_chars, 0)::bigint as line_dup_chars,
             coalesce(l.line_chars, 0)::bigint as line_chars,
             {", ".join(f"coalesce(max(c.chars) filter (c.n = {n}), 0)::bigint as dup_chars_{n}" for n in NGRAM_LIMITS)}
      from d left join doc using (r) left join lines l using (r) left join chars c on c.r = d.r group by all)
select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {BASE_PERCENT} * n_words as base_failed,
       not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {BASE_PERCENT} * n_words) and not (line_chars > 0 and line_dup_chars > {LINE_LIMIT} * line_chars)
       {" ".join(f"and not (word_chars > 0 and dup_chars_{n} > {x} * word_chars)" for n, x in NGRAM_LIMITS.items())} as kept
from m
"""}
