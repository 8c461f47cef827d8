"""Fill-in-the-middle transformation by one counted-quantifier match per text.

A unit is a word with the white space before it, or white space at the end.  `regexp_count` gives their number n; two
hashed draws a <= b cut the text after a and after b units.  Each row has a pattern of its own,
`(unit{a})(unit{b-a})(rest)`, whose groups are possessive: they are matched in a loop, never
given back, and so take time in proportion to the text and no stack, however many units there are.  One replacement by
that pattern writes the parts in their new order between the markers.  Columns only, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.text import SPACE_CLASS

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 50  # per cent of the texts that are cut
SUFFIX_FIRST = 80  # per cent of those that begin with their suffix
SEED = 42

_WORD_CLASS = "[^" + SPACE_CLASS[1:]
UNIT = f"{SPACE_CLASS}*+{_WORD_CLASS}++|{SPACE_CLASS}++"
# Where the parts stand in each form, and how they are read back from there.
_LAYOUT = {
    "psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2",
    "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2",
}
_READ = {
    "psm": (rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\z", "$1$3$2"),
    "spm": (rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\z", "$2$3$1"),
}


def _by_form(form: Column, values: dict[str, str]) -> Column:
    return F.when(form == "psm", values["psm"]).otherwise(values["spm"])


def _draws(id_: Column, seed: int) -> Column:
    """The first four 8-digit groups of the hash of seed and id, as an array of integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def with_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
    seed: int = SEED,
) -> DataFrame:
    """Per input row: id, n, form, output, prefix_chars, middle_chars.

    `rate` per cent of the texts are cut, `suffix_first` per cent of these into spm (suffix, prefix, middle), the rest
    into psm; the others are plain: unchanged, with null part lengths.  A text that holds a marker is always plain,
    so that no output can be misread.

    Null counts as empty; empty texts are plain with n 0.  White space alone is one unit, whose cuts leave
    parts empty.  A null id draws like an empty one.  Every row is decided by its id and text alone: repeated rows
    get equal results, ties cannot occur, other columns are not read.  Texts of any length are cut whole.
    An empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), whole.alias("text"), _draws(F.col(id_col), seed).alias("h"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (F.col("h")[2] % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h")[3] % 100 < suffix_first, "spm").otherwise("psm")
    one, two = F.col("h")[0] % (F.col("n") + 1), F.col("h")[1] % (F.col("n") + 1)
    rows = rows.select("id", "text", "n", form.alias("form"), F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    is_plain, group = F.col("form") == "plain", F.lit(f"((?:{UNIT}){{")
    pattern = F.concat(
        F.lit(r"(?s)\A"), group, F.col("a").cast("string"), F.lit("}+)"),
        group, (F.col("b") - F.col("a")).cast("string"), F.lit(r"}+)(.*)\z"),
    )
    moved = F.regexp_replace(F.col("text"), pattern, _by_form(F.col("form"), _LAYOUT))
    rows = rows.select("id", "n", "form", F.when(is_plain, F.col("text")).otherwise(moved).alias("output"))
    # The text holds no marker, so the first of each is the one that was written.
    at = {m: F.instr("output", m) for m in (PREFIX, SUFFIX, MIDDLE)}
    after_prefix = F.when(F.col("form") == "psm", at[SUFFIX]).otherwise(at[MIDDLE])
    prefix = after_prefix - at[PREFIX] - len(PREFIX)
    middle = F.char_length("output") - at[MIDDLE] - len(MIDDLE) + 1
    return rows.select(
        F.col("id").alias(id_col), "n", "form", "output",
        F.when(~is_plain, prefix.cast("long")).alias("prefix_chars"),
        F.when(~is_plain, middle.cast("long")).alias("middle_chars"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    patterns, order = ({k: v[i] for k, v in _READ.items()} for i in (0, 1))
    return F.when(form == "plain", output).otherwise(F.regexp_replace(output, _by_form(form, patterns), _by_form(form, order)))


def middle_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`with_middle` with the digests of the output and of the text rebuilt from it in place of the output."""
    found = with_middle(docs, id_col, text_col, **options)

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    back = digest(restored(F.col("output"), F.col("form")))
    return found.select(
        id_col, "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        back.alias("restored_sha256"),
    )


def oracle_query(table: str = "documents") -> str:
    """The digests as DuckDB SQL: units as a list, parts as slices of it."""
    group = "('0x' || substr(h, {0}, 8))::BIGINT"
    unit = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    part = "array_to_string(units[{0}:{1}], '')"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '{unit}') AS units, {group.format(17)} AS h3, {group.format(25)} AS h4 FROM t),
c AS (SELECT *, len(units)::BIGINT AS n, {group.format(1)} % (len(units) + 1) AS x, {group.format(9)} % (len(units) + 1) AS y,
  CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
    OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, n, form, text, {part.format("1", "least(x, y)")} AS pre,
  {part.format("least(x, y) + 1", "greatest(x, y)")} AS mid, {part.format("greatest(x, y) + 1", "n")} AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
    ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p""".replace("FROM documents", f"FROM {table}")
