"""Quality rules: a table of thresholds compiled into one projection.

Every rule bounds a ratio of counts of the whole text. The counts are built-in
expressions over the array of words and the array of lines, so that a text is
judged in one pass over its row, without a shuffle and without user functions.

Repeated three-word windows are found by sorting, in the row, one long per
window: its hash above its position. Neighbours with equal hashes are then
compared word by word; a text in which two different windows agree in the hash
is counted again by sorting the windows themselves, so the count is exact.

Defined results: a null or empty text has no words, all counts are 0 and it
fails the base rule; a null id stays null; repeated rows give repeated rows; an
empty table an empty result. Only ``key`` and ``text`` are read, so other
columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of four languages.
STOP_WORDS = (
    "a an and are as at be by for from has have in is it not of on or that the this to was with "
    "das den der des die ein eine für im ist mit nicht und von zu "
    "au avec dans de du en est et la le les par pas pour que qui sur un une "
    "al con del el es las lo los no para por se su una y"
).split()

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The threshold table: (name, numerator, denominator, least, most). A rule
#: holds if least <= numerator / denominator <= most; None is no bound, and a
#: ratio with denominator 0 violates no rule.
RULES: list[tuple[str, str, str, float | None, float | None]] = [
    ("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    ("symbols_per_word", "n_symbols", "n_words", None, 0.2),
    ("capitals_per_character", "n_capitals", "word_chars", None, 0.4),
    ("stop_words_per_word", "n_stop_words", "n_words", 0.02, None),
    ("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
    ("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
    ("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.5),
]
#: the base rule, which the table cannot soften
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

_GAP = r"[\\x20\\x09-\\x0D]"
_NO_GAP = r"[^\\x20\\x09-\\x0D]"
# starts of both of two neighbours in the order of the hashes
_WINDOW = "array(get(_words, {0}), get(_words, {0} + 1), get(_words, {0} + 2))"
_HASH = "shiftrightunsigned(get(_packed, {0}), _bits)"
_AT = "cast(get(_packed, {0}) & (shiftleft(1L, _bits) - 1) as int)"


def counts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All counts that the rules use, next to ``key``."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    last, this = "i - 1", "i"
    starts = f"flatten(transform(_again, i -> array({_AT.format(last)}, {_AT.format(this)})))"
    differ = f"exists(_again, i -> {_WINDOW.format(_AT.format(last))} <> {_WINDOW.format(_AT.format(this))})"
    # the slow way, for texts with two windows of the same hash
    windows = f"sort_array(transform(sequence(0, size(_words) - 3), i -> struct({_WINDOW.format('i')} as w, i as at)))"
    exact = f"""transform(array({windows}), s -> flatten(transform(s, (x, i) ->
        if(get(s, i - 1).w = x.w, array(get(s, i - 1).at, x.at), cast(array() as array<int>)))))[0]"""
    return (
        docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .withColumns(
            {
                "_words": F.expr(rf"filter(split(_text, '{_GAP}+'), w -> w <> '')"),
                "_lines": F.expr(rf"filter(split(_text, '\\n'), l -> l rlike '{_NO_GAP}')"),
            }
        )
        .withColumn("_bits", F.expr("length(bin(size(_words)))"))
        .withColumn(
            "_packed",
            F.expr(
                "sort_array(transform(sequence(0, greatest(size(_words) - 3, 0)), i -> shiftleft("
                "xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)), _bits) | cast(i as bigint)))"
            ),
        )
        .withColumn(
            "_again",
            F.expr(
                "filter(sequence(1, greatest(size(_packed) - 1, 1)), "
                f"i -> {_HASH.format(last)} = {_HASH.format(this)})"
            ),
        )
        .withColumn(
            "_starts",
            F.expr(f"array_distinct(case when size(_again) = 0 then cast(array() as array<int>) when {differ} then {exact} else {starts} end)"),
        )
        .selectExpr(
            f"`{key}`",
            "cast(size(_words) as bigint) as n_words",
            "cast(aggregate(_words, 0, (n, w) -> n + length(w)) as bigint) as word_chars",
            f"cast(length(_text) - length(translate(_text, '{SYMBOLS}', '')) as bigint) as n_symbols",
            "cast(size(_lines) as bigint) as n_lines",
            "cast(size(_lines) - size(array_distinct(_lines)) as bigint) as n_dup_lines",
            "cast(if(size(_starts) = 0, 0, size(array_distinct(flatten(transform(_starts, i -> array(i, i + 1, i + 2)))))) as bigint)"
            " as n_repeat_words",
            f"cast(length(_text) - length(translate(_text, '{CAPITALS}', '')) as bigint) as n_capitals",
            f"cast(size(filter(_words, w -> lower(w) in ({stop}))) as bigint) as n_stop_words",
            rf"cast(size(filter(_lines, l -> l rlike '^{_GAP}*[-*•]')) as bigint) as n_bullet_lines",
            rf"cast(size(filter(_lines, l -> l rlike '(\\.\\.\\.|…){_GAP}*$')) as bigint) as n_ellipsis_lines",
        )
    )


def conditions(rules=None) -> list[str]:
    """The threshold table as SQL conditions, the same in both dialects."""
    held = []
    for _, above, below, least, most in RULES if rules is None else rules:
        if least is not None:
            held.append(f"({below} = 0 or {above} >= cast({float(least)!r} as double) * {below})")
        if most is not None:
            held.append(f"({below} = 0 or {above} <= cast({float(most)!r} as double) * {below})")
    return held or ["true"]


BASE_FAILED = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words"


def judge(docs: DataFrame, text: str = "text", key: str = "doc_id", rules=None) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row."""
    return (
        counts(docs, text, key)
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("kept", ~F.col("base_failed") & F.expr(" and ".join(conditions(rules))))
    )


def passing(docs: DataFrame, text: str = "text", rules=None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    whole = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text"))
    # A filter is not moved below a projection with a row number. Moved, it would
    # hold a copy of all the counts for every time that one is mentioned.
    judged = judge(whole, "__text", "__row", rules).withColumn("__number", F.monotonically_increasing_id())
    return judged.where("kept and __number >= 0").select("__row.*")


def sql(documents: str = "documents", rules=None) -> str:
    """The same as DuckDB SQL."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    gap, no_gap = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    return rf"""
with t as (
  select row_number() over () as r, doc_id, coalesce("text", '') as x from {documents}
), a as (
  select *, regexp_extract_all(x, '{no_gap}+') as w,
    list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '{no_gap}')) as l from t
), g as (
  select r, unnest(range(1, len(w) - 1)) as i, unnest([[w[j], w[j + 1], w[j + 2]] for j in range(1, len(w) - 1)]) as g from a
), d as (
  select r, i, count(*) over (partition by r, g) as n from g
), p as (
  select r, count(distinct i + s) as n from d, (select unnest([0, 1, 2]) as s) where n > 1 group by r
), c as (
  select doc_id, len(w) as n_words, length(regexp_replace(x, '{gap}', '', 'g')) as word_chars,
    length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
    coalesce(p.n, 0) as n_repeat_words, length(regexp_replace(x, '[^A-Z]', '', 'g')) as n_capitals,
    len(list_filter(w, lambda y: lower(y) in ({stop}))) as n_stop_words,
    len(list_filter(l, lambda y: regexp_matches(y, '^{gap}*[-*•]'))) as n_bullet_lines,
    len(list_filter(l, lambda y: regexp_matches(y, '(\.\.\.|…){gap}*$'))) as n_ellipsis_lines
  from a left join p using (r)
), b as (select *, {BASE_FAILED} as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {" and ".join(conditions(rules))} as kept
from b"""
