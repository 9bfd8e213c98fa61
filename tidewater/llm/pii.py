"""Personal data, and terms that give it away.

Base spans are what patterns find: mail and network addresses, card and phone numbers. Beyond them, information-
theoretic sanitisation: over the whole corpus, how much does a term tell about a protected entity (a base value)? With
N documents, n(e) with the entity, n(t) with the term and n(e,t) with the term near the entity,

    PMI(e; t) = log2(N n(e,t) / (n(e) n(t))),    IC(e) = log2(N / n(e)),    disclosure = PMI / IC  (1: t implies e).

A term whose disclosure of some entity reaches the threshold, with enough documents behind it, is itself a span
wherever it occurs; ``sanitise`` replaces base spans by their kind and generalises or removes the terms.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm._common import broadcast_within, saved, text_of

#: Fixed values of the contract. The groups are possessive and a look-behind keeps a failed run from being tried again
#: from each of its characters; neither changes a match (``\G``: a match may begin where the last one ended), but texts
#: of any length then cost linear time and no stack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: A cheap necessary condition of each kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": "(?:[0-9][ -]?){16}", "phone": r"\+[0-9]"}
OCTETS = r"\A0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}\z"
NOT_TERM = r"[^\p{L}\p{N}]+"
#: Terms this near to an entity, in words, count as together with it.
NEAR = 10
MIN_DOCS, THRESHOLD = 3, 0.9
MAX_BROADCAST = 1_000_000
STEP = 256


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def matches(text: Column, pattern: Column | str) -> Column:
    """All matches, leftmost and not overlapping, as array of (start, end, value); code points, end exclusive.

    The pieces between the matches give their places. Running sums go through sums of ``STEP`` lengths each, so a text
    with very many matches doesn't cost the square of their number."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    both = F.zip_with(gaps, found, lambda g, m: F.struct(
        g.alias("gap"), F.length(m).alias("len"), (g + F.length(m)).alias("all"), m.alias("value")))

    def place(parts: Column) -> Column:
        lens = F.transform(parts, lambda p: F.coalesce(p["all"], F.lit(0)))
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / STEP).cast("int")),
                             lambda b: _sum(F.slice(lens, b * STEP + 1, F.lit(STEP))))

        def one(p: Column, i: Column) -> Column:
            block = F.floor(i / STEP).cast("int")
            start = _sum(F.slice(blocks, F.lit(1), block)) + _sum(F.slice(lens, block * STEP + 1, i % STEP)) + p["gap"]
            return F.struct(start.alias("start"), (start + p["len"]).alias("end"), p["value"].alias("value"))

        return F.transform(F.filter(parts, lambda p: p["value"].isNotNull()), one)

    return place(both)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1))
        .otherwise(d.cast("int")))
    return _sum(each) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(OCTETS)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


EMPTY = "array<struct<start:int,end:int,value:string>>"


def base_spans(text: Column) -> dict[str, Column]:
    """The valid base spans of each kind in order."""
    def spans(kind: str) -> Column:
        found = F.filter(matches(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
        return F.when(text.rlike(HINTS[kind]), found).otherwise(F.array().cast(EMPTY)).cast(EMPTY)

    return {kind: spans(kind) for kind in KINDS}


def with_base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return text.select("id", "text", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])


def lowered(text: Column) -> Column:
    """The text in lower case, character by character: only U+0130 would become two, and is an i here."""
    return F.lower(F.translate(text, "\u0130", "i"))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), NOT_TERM), "")


def words_near(text: str, place: str, near: int) -> Column:
    """The ``near`` words before and behind the span ``place`` (start, end) of the column ``text``, or as many as there
    are. Some characters usually hold them; where they don't, a pattern takes them from the whole side, the one before
    the span in reverse."""
    reach = 40 * near
    word = r"[\p{L}\p{N}]"
    first = rf"\A(?:[^\p{{L}}\p{{N}}]*+{word}++){{0,{near}}}"
    before = F.expr(f"substring({text}, greatest(1, {place}.start + 1 - {reach}), least({place}.start, {reach}))")
    behind = F.expr(f"substring({text}, {place}.end + 1, {reach})")
    far = F.reverse(F.regexp_extract(F.reverse(F.expr(f"substring({text}, 1, {place}.start)")), first, 0))
    on = F.regexp_extract(F.expr(f"substring({text}, {place}.end + 1)"), first, 0)
    # One word more than wanted: none of the wanted is cut off by the reach.
    before = F.when((F.col(f"{place}.start") <= reach) | (F.size(words_of(before)) > near), before).otherwise(far)
    behind = F.when((F.length(behind) < reach) | (F.size(words_of(behind)) > near), behind).otherwise(on)
    return F.concat(F.slice(F.reverse(words_of(before)), 1, near), F.slice(words_of(behind), 1, near))


def disclosing_terms(docs: DataFrame, base: DataFrame, near: int = NEAR, min_docs: int = MIN_DOCS,
                     threshold: float = THRESHOLD) -> DataFrame:
    """(term): those whose disclosure of some entity reaches ``threshold`` in ``min_docs`` documents or more.

    ``docs`` (id, text) gives N and n(t); ``base`` are the same rows with their base spans. Terms are lower-cased runs
    of letters and digits, three or more characters and with a letter. Each occurrence of an entity looks at ``near``
    words before and behind it, so the work is linear in the occurrences."""
    total = docs.count()

    def entities_of(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(
            F.concat(F.lit(kind + ":"), F.lower(s["value"])).alias("entity"), s["start"].alias("start"),
            s["end"].alias("end")))

    spans = (base.where(" or ".join(f"size({k}) > 0" for k in KINDS))
             .select("id", "text", F.explode(F.concat(*map(entities_of, KINDS))).alias("s")))
    around = words_near("text", "s", near)
    ok = (F.length("term") >= 3) & F.col("term").rlike(r"\p{L}")
    # A document is counted once for an entity and once for a pair, whatever the number of occurrences.
    near_pairs = saved(spans.select("id", F.col("s.entity").alias("entity"), F.explode(F.array_distinct(around))
                                    .alias("term")).where(ok).distinct(), "pii-near")
    entities = spans.select("id", F.col("s.entity").alias("entity")).distinct().groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_e"))
    # A term is in as many documents at least as it is near any entity in (m); those for which that alone is too much
    # need no count over the corpus.
    seen = near_pairs.select("id", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("m"))
    few = F.col("n_et") * F.pow(F.lit(float(max(total, 1))) / F.col("n_e"), F.lit(1 - threshold)) * (1 + 1e-9)
    pairs = saved(near_pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))
                  .where(F.col("n_et") >= min_docs).join(entities, "entity").join(seen, "term")
                  .where(F.col("m") <= few).select("entity", "term", "n_et", "n_e"), "pii-pairs")
    wanted = saved(pairs.select("term").distinct(), "pii-candidates")
    terms = (docs.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("term"))
             .join(broadcast_within(wanted, MAX_BROADCAST), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n_t")))
    n = F.lit(float(max(total, 1)))
    pmi = F.log2(n * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    ic = F.log2(n / F.col("n_e"))
    return (pairs.join(terms, "term")
            .where((ic > 0) & (pmi >= ic * threshold)).select("term").distinct())


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: int = NEAR,
               min_docs: int = MIN_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """``id``, ``text`` (null as empty), the spans of each base kind and of ``term``: arrays of (start, end, value),
    code points from 0, end exclusive.

    Empty and null texts have no spans. Repeated rows and rows that share an id are each searched; each counts as a
    document. An empty table gives an empty result; other columns are not read."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    base = with_base(docs, id_col, text_col)
    marked = saved(disclosing_terms(rows, base, near, min_docs, threshold), "pii-terms")
    # Which documents hold which of the terms; only those are searched for their places.
    holds = (rows.select("id", F.explode(F.array_distinct(words_of(F.col("text")))).alias("term"))
             .join(broadcast_within(marked, MAX_BROADCAST), "term")
             .groupBy("id").agg(F.array_sort(F.collect_set("term")).alias("held")).withColumnRenamed("id", "held_id"))
    holds = saved(holds, "pii-holds")
    out = base.join(broadcast_within(holds, MAX_BROADCAST // 10), F.col("id").eqNullSafe(F.col("held_id")), "left")
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join("held", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    spans = F.when(F.col("held").isNotNull(), matches(lowered(F.col("text")), pattern)).otherwise(F.array().cast(EMPTY))
    return out.select("id", "text", *KINDS, spans.cast(EMPTY).alias("term"))


def sanitise(found: DataFrame, generalise: bool = True) -> DataFrame:
    """``found`` (from find_spans) with ``clean``: base spans replaced by <EMAIL>, <IP>, <CARD>, <PHONE>, terms by
    <TERM> or by nothing. Where spans overlap, the text they cover together is replaced once, by the first's kind."""
    names = {k: f"<{k.upper()}>" for k in KINDS} | {"term": "<TERM>" if generalise else ""}

    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(names[kind]).alias("name")))

    spans = F.array_sort(F.concat(*map(named, names)))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def one(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        part = F.concat(F.col("text").substr(acc["at"] + 1, s["start"] - acc["at"]), s["name"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["parts"], F.array(part))).otherwise(acc["parts"]).alias("parts"))

    clean = F.aggregate(spans, begin, one, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.col("text").substr(acc["at"] + 1, F.length("text"))))
    return found.withColumn("clean", F.when(F.size(spans) > 0, clean).otherwise(F.col("text")))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, and the spans as kind:start:end by kind, then start, comma-joined."""
    def places(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.concat_ws(
            ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    def listed(kinds: tuple[str, ...]) -> Column:
        return F.array_join(F.concat(*map(places, kinds)), ",")

    return found.select(F.col("id").alias(id_col), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(listed(KINDS), 256).alias("base_sha256"), listed((*KINDS, "term")).alias("spans"),
                        F.size("term").cast("long").alias("n_term"))
