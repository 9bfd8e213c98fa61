"""Fill-in-the-middle transformation by one counted regular expression a row.

A text is a run of units (a word of ASCII letters, or any other single code point). ``regexp_count`` gives their number
n; hashes of the row's id choose two cuts a <= b in 0..n; and the pattern

    \\A((?:unit){a}+)((?:unit){b-a}+)(.*)\\z

which is built for each row, captures prefix, middle and suffix in one match. The possessive counts matter: the unit
alternates, so a backtracking count keeps a stack frame for each repetition and a long text overflows the stack, while
a possessive one is a plain loop. Nothing is shuffled and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm._common import text_of

UNIT = r"(?:[A-Za-z]+|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")


def _draw(id_col: str, seed: str, i: int) -> Column:
    """The i-th number (from 0) of 32 bits that belongs to the row's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def pattern(a: Column, b: Column) -> Column:
    """Captures prefix (a units), middle (b - a units) and suffix; a and b are written into it."""
    return F.concat(F.lit(rf"(?s)\A({UNIT}{{"), a, F.lit(rf"}}+)({UNIT}{{"), b - a, F.lit(r"}+)(.*)\z"))


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_percent: int = 10,
                spm_percent: int = 20, seed: str = "1") -> DataFrame:
    """One row per row of ``docs``: id, ``n`` units, ``form``, ``output`` and the lengths of prefix and middle in code
    points.

    ``psm`` is prefix, suffix, middle, each behind its marker; ``spm`` is suffix, prefix, middle (``spm_percent`` of the
    rows that are cut). ``plain`` rows keep their text, and both lengths are null: ``plain_percent`` of the rows, empty
    and null texts, and texts that hold a marker themselves, so an output can always be taken apart again. The choice
    and the cuts hang on the id alone: rows that share an id (or have none) share their draws, and equal rows give equal
    rows. Other columns of ``docs``, whatever their names, are not read; an empty table gives an empty result. A text of
    any length is one row in one task.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("txt"),
                       *[_draw(id_col, seed, i).alias(f"h{i + 1}") for i in range(4)])
    rows = rows.withColumn("n", F.regexp_count("txt", F.lit(UNIT)).cast("long"))
    x, y = (F.col(h) % (F.col("n") + 1) for h in ("h1", "h2"))
    marked = F.contains("txt", F.lit(PREFIX)) | F.contains("txt", F.lit(SUFFIX)) | F.contains("txt", F.lit(MIDDLE))
    form = (F.when((F.col("txt") == "") | marked | (F.col("h3") % 100 >= 100 - plain_percent), "plain")
            .when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    cut = F.regexp_replace("txt", pattern(F.least(x, y), F.greatest(x, y)), order)
    rows = rows.withColumn("form", form).select(
        "id", "n", "form", F.when(F.col("form") == "plain", F.col("txt")).otherwise(cut).alias("output"))
    prefix, middle, _ = parts()
    return rows.select(F.col("id").alias(id_col), "n", "form", "output",
                       F.length(prefix).cast("long").alias("prefix_chars"),
                       F.length(middle).cast("long").alias("middle_chars"))


def parts(output: str = "output", form: str = "form") -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of a transformed text, read from its markers; nulls for ``plain``."""
    spm, out = F.col(form) == "spm", F.col(output)
    front = F.split_part(out, F.lit(MIDDLE), F.lit(1))  # a text that is cut holds no marker, so each is there once
    middle = F.split_part(out, F.lit(MIDDLE), F.lit(2))
    inner = F.when(spm, PREFIX).otherwise(SUFFIX)
    before = F.split_part(F.substr(front, F.lit(len(PREFIX) + 1)), inner, F.lit(1))  # behind the leading marker
    after = F.split_part(front, inner, F.lit(2))
    cut = F.col(form) != "plain"
    return (F.when(cut, F.when(spm, after).otherwise(before)), F.when(cut, middle),
            F.when(cut, F.when(spm, before).otherwise(after)))


def restored(output: str = "output", form: str = "form") -> Column:
    """The original text, from ``output`` and ``form`` alone."""
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(F.concat(*parts(output, form)))


def digest(cut: DataFrame) -> DataFrame:
    """``fill_middle``'s rows with the hashes of the output and of the text rebuilt from it in place of the output."""
    return cut.select(*[c for c in cut.columns if c != "output"], F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))
