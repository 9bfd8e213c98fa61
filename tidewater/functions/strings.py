"""String and name functions, all built from JVM-side Spark expressions (codegen-friendly, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._util import col


def camel_to_snake(c) -> Column:
    """Underscore before every capital (A-Z) but the first character, all lower-case (`camelCaseID` -> `camel_case_i_d`)."""
    marked = F.transform(F.split(col(c), ""), lambda ch, i: F.when((i > 0) & ch.between("A", "Z") & (F.length(ch) == 1),
                                                                   F.concat(F.lit("_"), ch)).otherwise(ch))
    return F.lower(F.array_join(marked, ""))


def snake_name(name: str) -> str:
    """``camel_to_snake`` for one name."""
    return "".join("_" + ch if i and "A" <= ch <= "Z" else ch for i, ch in enumerate(name)).lower()


def camel_name(name: str) -> str:
    """``snake_to_camel`` for one name."""
    first, *rest = name.split("_")
    return first + "".join(part.title() for part in rest)


def title_word(c) -> Column:
    """Python ``str.title`` on one word: a letter is upper-cased when the previous character is not a letter
    (so letters after digits are capitalised too), every other letter is lower-cased."""
    chars = F.split(col(c), "")
    return F.array_join(
        F.transform(
            chars,
            lambda ch, i: F.when(
                (i == 0) | ~F.element_at(chars, i).rlike(r"^\p{L}$"), F.upper(ch)
            ).otherwise(F.lower(ch)),
        ),
        "",
    )


def snake_to_camel(c) -> Column:
    """First `_` component as is, every later component title-cased, all joined without separator."""
    parts = F.split(col(c), "_", -1)
    return F.array_join(
        F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(title_word(p))), ""
    )


def preplace(c, seq: str, pre: str, overlapping: bool = False) -> Column:
    """Insert ``pre`` before each occurrence of ``seq``.

    Non-overlapping form splits on ``seq`` and re-joins with ``pre + seq``; the overlapping form marks every start
    position, also inside an earlier match (they differ on e.g. ``aaa`` / ``aa``). Empty arguments are an error.
    """
    if not seq or not pre:
        raise ValueError("a sequence to look for and a text to insert are both needed")
    if overlapping:
        import re
        return F.regexp_replace(col(c), f"(?={re.escape(seq)})", pre.replace("\\", "\\\\").replace("$", "\\$"))
    return F.replace(col(c), F.lit(seq), F.lit(pre + seq))


def count_char(c, ch: str) -> Column:
    """Occurrences of one character (or substring) in a string; null stays null."""
    s = col(c)
    return ((F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))) / F.lit(len(ch))).cast("bigint")


def path_segment(c, sep: str = "/") -> Column:
    """Split on ``sep``; a 6-part path yields the second part from the end, anything else the last part."""
    parts = F.split(col(c), sep, -1)
    return F.when(F.size(parts) == 6, F.element_at(parts, -2)).otherwise(F.element_at(parts, -1))


def contains_any(c, needles, case_insensitive: bool = True) -> Column:
    """True when the text contains any of the needles (case-insensitive by default)."""
    s = F.lower(col(c)) if case_insensitive else col(c)
    out = None
    for n in needles:
        term = s.contains(n.lower() if case_insensitive else n)
        out = term if out is None else (out | term)
    return out if out is not None else F.lit(False)


def concat_nonempty(fields: dict | list) -> Column:
    """``name:value`` for each field whose value is truthy, joined by ``;`` (null, "" and 0 are skipped)."""
    items = fields.items() if isinstance(fields, dict) else [(f, f) for f in fields]
    parts = []
    for name, c in items:
        v = col(c)
        s = v.cast("string")
        truthy = v.isNotNull() & (s != "") & (s != "0") & (s != "false")
        parts.append(F.when(truthy, F.concat(F.lit(f"{name}:"), s)))
    return F.concat_ws(";", *parts)


def join_path(parts, suffix: str | None = None) -> Column:
    """Join non-empty path parts with `/` after stripping slashes at both ends, and append a file suffix."""
    cleaned = [F.nullif(F.expr(f"trim(BOTH '/' FROM {_sql(p)})"), F.lit("")) for p in parts]
    path = F.concat_ws("/", *cleaned)
    return F.concat(path, F.lit(suffix)) if suffix else path


def _sql(p) -> str:
    if isinstance(p, str):
        return f"`{p}`"
    raise TypeError("join_path takes column names")


def hash_filename(c, new_prefix: str) -> Column:
    """``new_prefix/md5(parent path)-file name`` for an object key."""
    key = col(c)
    parent = F.regexp_extract(key, r"^(.*)/[^/]*$", 1)
    name = F.regexp_extract(key, r"([^/]*)$", 1)
    return F.concat(F.lit(new_prefix.rstrip("/") + "/"), F.md5(parent), F.lit("-"), name)


def hash_bucket(c) -> Column:
    """``type:id`` -> struct(key, field): ids longer than 2 characters go to bucket ``type:<id without last 2>``
    with field = last 2 characters; short ids go to ``type:`` with the whole id as field. (Cutting exactly the
    two characters kept as field means two ids can never share a bucket and field.)"""
    parts = F.split(col(c), ":", 2)
    t, i = F.element_at(parts, 1), F.element_at(parts, 2)
    long_id = F.length(i) > 2
    key = F.when(long_id, F.concat(t, F.lit(":"), F.substr(i, F.lit(1), F.length(i) - 2))) \
        .otherwise(F.concat(t, F.lit(":")))
    field = F.when(long_id, F.substr(i, F.length(i) - 1, F.lit(2))).otherwise(i)
    return F.struct(key.alias("key"), field.alias("field"))


def strip_env_prefix(c, known_folders) -> Column:
    """Database template path -> folder path.

    The first `/` part is the database. A database with more than one `_` part that is not a known folder loses its
    first `_` part (``test_dbr`` -> ``dbr``). Remaining `/` parts are appended when the database changed and the next
    part is non-empty. The result always ends with `/`; null and "" give `/`.
    """
    s = F.coalesce(col(c), F.lit(""))
    parts = F.split(s, "/", -1)
    db = F.element_at(parts, 1)
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    known = F.array(*[F.lit(k) for k in known_folders]) if known_folders else F.array().cast("array<string>")
    db_parts = F.split(db, "_", -1)
    strip = (F.size(db_parts) > 1) & ~F.array_contains(known, db)
    stripped = F.array_join(F.slice(db_parts, 2, F.greatest(F.size(db_parts) - 1, F.lit(1))), "_")
    changed = strip & (stripped != s)
    with_rest = F.when(changed & (F.size(rest) > 0) & (F.element_at(rest, 1) != ""),
                       F.array_join(F.concat(F.array(stripped), rest), "/")).otherwise(stripped)
    path = F.when(s == "", F.lit("")).when(strip, with_rest).otherwise(s)
    return F.when(path.endswith("/"), path).otherwise(F.concat(path, F.lit("/")))


def capacity_percent(report, external_gb) -> Column:
    """Percent of licence used from a two-line report.

    Line 1, 4th space-separated token: used TB; line 2, last token: total TB (both may carry a ``TB`` suffix).
    TB values are turned into integer GB (x1024, truncated); the external share is subtracted from the used GB;
    the percentage is truncated toward zero.
    """
    lines = F.split(col(report), "\n")
    used_tok = F.element_at(F.split(F.element_at(lines, 1), " "), 4)
    total_tok = F.element_at(F.split(F.element_at(lines, 2), " "), -1)
    used = (F.replace(used_tok, F.lit("TB"), F.lit("")).cast("double") * 1024).cast("bigint")
    total = (F.replace(total_tok, F.lit("TB"), F.lit("")).cast("double") * 1024).cast("bigint")
    return ((used - col(external_gb)) / total * 100).cast("bigint")


def suffix_match(c, suffix: str) -> Column:
    return col(c).contains(suffix)


def trim_all(c) -> Column:
    return F.trim(col(c))
