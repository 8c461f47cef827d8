"""Quality rules: a threshold table compiled into one Spark projection.

Each rule bounds one measure of a text.  Measures are built-in column expressions over the word and line
arrays; there is no shuffle and no user function.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.text import ROW, SPACE_CLASS, let, words, wrapped

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

# Frequent function words of the languages served; a text needs a small share of them.
STOP_WORDS = (
    "the of and to a in is it that for on with as are was by be this from at or an not "
    "der die das und ist in zu den von mit ein eine für auf im dem des sich nicht auch an "
    "le la les de des et un une en est que qui dans pour au par sur il elle pas avec du "
    "el los las y del se un una por con para su al lo como más o que no es"
).split()


class Rule(NamedTuple):
    """Bounds, inclusive, of one measure; None leaves a side open."""

    measure: str
    low: float | None = None
    high: float | None = None


# The threshold table.  It rejects what is plainly not prose and leaves doubtful texts alone.
RULES = (
    Rule("mean_word_chars", 1.5, 20.0),
    Rule("symbols_per_word", None, 0.3),
    Rule("stop_word_share", 0.01, None),
    Rule("dup_line_share", None, 0.7),
)


def _measure_words(w: Column) -> Column:
    """n_repeat_words of a word array: words inside 3-word windows that occur twice or more.

    Window hashes are sorted with their positions, so equal windows are neighbours; the covered words are
    then counted along the sorted positions.  Work grows with n log n, also for very repetitive texts.
    """
    last = F.size(w) - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    windows = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))
    )

    def repeated(s: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            before = (j > 0) & (F.get(s, j - 1)["h"] == x["h"])
            return before | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)

    return let(windows, lambda s: let(repeated(s), covered))


def measures(text: Column) -> Column:
    """Struct of all measures of a text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^" + SPACE_CLASS[1:]))
    return F.struct(
        F.char_length(F.regexp_replace(whole, SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("lines"), F.size(F.array_distinct(x)).alias("unlike"))).alias("l"),
        let(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"), _measure_words(w).alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("stop_words"),
            ),
        ).alias("w"),
    )


def quality_columns(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with a column `_quality`: the measures, `base_failed` and `kept`.

    Words are runs of non-space characters.  Null, empty and blank texts have no words, fail the base rule and
    are not kept.  Rules only apply to texts with words, so no ratio divides by zero.  Every row is
    judged on its own: ties, repeated rows and other columns have no influence.
    """
    found = docs.withColumn("_quality", measures(F.col(text_col)))
    q = F.col("_quality")
    n, repeats, lines = q["w"]["n_words"], q["w"]["n_repeat_words"], q["l"]["lines"]
    per_word = F.greatest(n, F.lit(1))
    values = {
        "mean_word_chars": q["word_chars"] / per_word,
        "symbols_per_word": q["n_symbols"] / per_word,
        "stop_word_share": q["w"]["stop_words"] / per_word,
        "dup_line_share": (lines - q["l"]["unlike"]) / F.greatest(lines, F.lit(1)),
    }
    base_failed = (n < MIN_WORDS) | (repeats * 100 > n * MAX_REPEAT_PERCENT)
    fits = ~base_failed
    for rule in rules:
        if rule.low is not None:
            fits = fits & (values[rule.measure] >= rule.low)
        if rule.high is not None:
            fits = fits & (values[rule.measure] <= rule.high)
    verdict = F.struct(
        n.alias("n_words"), q["word_chars"].alias("word_chars"), q["n_symbols"].alias("n_symbols"),
        (lines - q["l"]["unlike"]).cast("long").alias("n_dup_lines"), repeats.alias("n_repeat_words"),
        *[values[r].alias(r) for r in values], base_failed.alias("base_failed"), fits.alias("kept"),
    )
    return found.withColumn("_quality", verdict)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the base counts, base_failed and kept."""
    found = quality_columns(docs.select(F.col(id_col), F.col(text_col)), text_col).select(id_col, "_quality.*")
    return found.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` without the rows that the rules reject; columns unchanged, whatever their names.

    Null, empty, very long and repeated texts are treated as in `quality_columns`; an empty table stays empty.
    """
    rows = wrapped(docs, text=F.col(text_col))
    return quality_columns(rows, "text").where("_quality.kept").select(f"{ROW}.*")


def _sql_words(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), '[^\\x20\\x09-\\x0D]+')"


def oracle_query(table: str = "documents", columns: str = "doc_id") -> str:
    """The report as DuckDB SQL, with `columns` carried along."""
    stop_list = ", ".join("'" + x + "'" for x in sorted(set(STOP_WORDS)))
    bounds = []
    exprs = {
        "mean_word_chars": "word_chars / n_words",
        "symbols_per_word": "n_symbols / n_words",
        "stop_word_share": "stop_words / n_words",
        "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    }
    for r in RULES:
        if r.low is not None:
            bounds.append(f"{exprs[r.measure]} >= {r.low}")
        if r.high is not None:
            bounds.append(f"{exprs[r.measure]} <= {r.high}")
    return f"""
WITH w AS (SELECT *, row_number() OVER () AS rid, {_sql_words("text")} AS ws,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ls
  FROM {table}),
tri AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS c FROM tri) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY rid),
m AS (SELECT w.*, len(ws)::BIGINT AS n_words,
    length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    len([x FOR x IN ws IF lower(x) IN ({stop_list})]) AS stop_words
  FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT {columns}, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(bounds)} AS kept FROM b"""
