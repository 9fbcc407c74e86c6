"""Secrets in whole texts, judged by how many owners and repositories share their value.

Everything is a column expression or a grouped aggregate; there is no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loticote.session import materialize

# The kinds in the order of the report, and their patterns.
KINDS = ["assign", "access", "hex", "owned"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Text that could be a credential without saying so: a long run of the characters of keys.
GENERIC = r"[A-Za-z0-9+/_=-]{20,}"
ASSIGN_VALUE_LENGTH = 6

SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def spans_of(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    The same expression cuts the text into the parts between the matches, so the place of a match is the
    length of all parts and matches before it.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    ends = running(F.zip_with(gaps, whole, lambda a, b: F.length(a) + F.length(b)), lambda a, b: a + b)
    placed = F.zip_with(ends, whole, lambda end, match: F.struct((end - F.length(match)).alias("start"), end.alias("end")))
    found = F.zip_with(
        placed,
        value,
        lambda s, v: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), v.alias("value")),
    )
    return F.when(text.rlike(pattern), found.cast(SPAN)).otherwise(F.array().cast(SPAN))


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Every value merged with all before it (sums, maxima).

    In each round a value takes in the one that stands 1, 2, 4, ... places before it, so n values take log2(n)
    rounds over the array, where a fold that appends to an array would copy it n times.
    """

    def round_(have: Column, power: Column) -> Column:
        shift = F.call_function("shiftleft", F.lit(1), power)
        before = F.concat(F.transform(F.sequence(F.lit(1), shift), lambda _: F.lit(None).cast("int")), F.slice(have, F.lit(1), F.size(have) - shift))
        return F.zip_with(have, before, lambda a, b: F.when(b.isNull(), a).otherwise(merge(a, b)))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int") - 1)
    return F.when(F.size(values) < 2, values).otherwise(F.aggregate(rounds, values, round_))


def base_spans(text: Column) -> Column:
    """The three kinds that the text alone decides. Patterns with a least length find the same spans as
    the unbounded runs with the short ones dropped, except for assignments, where short ones use up text."""
    assign = F.filter(spans_of(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= ASSIGN_VALUE_LENGTH)
    return F.concat(assign, spans_of(text, ACCESS, 1), spans_of(text, HEX, 2))


def generic_spans(text: Column) -> Column:
    """Long runs with digits and letters of both cases."""
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")
    return F.filter(spans_of(text, GENERIC, 3), mixed)


def looks_live(value: Column) -> Column:
    """Long enough and varied enough for a generated key."""
    return (
        (F.length(value) >= 16)
        & value.rlike("[0-9]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
    )


def outside_base(found: DataFrame) -> DataFrame:
    """Base spans, and those long runs that no base span of their row overlaps.

    A run overlaps one if the latest end of the base spans that start before its own end lies behind its start:
    one running maximum over the spans of a row.
    """
    base = F.col("span.kind") < 3
    place = F.when(base, F.col("span.start")).otherwise(F.col("span.end"))
    # A base span that starts where a run ends comes after it.
    so_far = Window.partitionBy("row").orderBy(place, base.cast("int")).rowsBetween(Window.unboundedPreceding, 0)
    reached = F.max(F.when(base, F.col("span.end"))).over(so_far)
    marked = found.withColumn("reached", F.coalesce(reached, F.lit(0)))
    return marked.where(base | (F.col("reached") <= F.col("span.start"))).drop("reached")


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every candidate value, by its hash."""
    return found.groupBy("hash").agg(
        F.count_distinct("owner").alias("n_owners"), F.count_distinct("repo").alias("n_repos")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    text = lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), text), ",")


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    example_owners: int = 3,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``doc_id, n_assign, n_access, n_hex, spans, n_live, n_example`` and ``keep``.

    ``spans`` is an array of (start, kind, end, value, n_owners, n_repos, live), in code points. It holds
    all base spans, and each long mixed run outside of them (kind 3, "owned") whose value fewer than
    ``example_owners`` owners have and that looks like a generated key. A value that at least
    ``example_owners`` owners have is a copied example: it is counted in ``n_example`` and adds no span.
    NULL texts are empty; NULL owners count as one owner, NULL repositories as one repository; repeated
    rows are rows of their own; an empty table gives no rows. Kept columns come out as ``keep_<name>``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        text.alias("text"),
        *(F.col(c).alias(f"keep_{c}") for c in keep),
    )
    kept = [f"keep_{c}" for c in keep]
    rows = rows.select(
        "doc_id", "repo", "owner", *kept, base_spans(F.col("text")).alias("base"), generic_spans(F.col("text")).alias("more")
    )
    # The row number only has to be the same in all later reads, so it is written with the rows.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    found = rows.select("row", "repo", "owner", F.explode(F.concat("base", "more")).alias("span"))
    found = outside_base(found).withColumn("hash", F.sha2(F.col("span.value"), 256))
    judged = found.select("row", "span", "hash").join(ownership(found), "hash")
    live = looks_live(F.col("span.value")) & (F.col("n_owners") < example_owners)
    judged = judged.withColumn("live", live).where((F.col("span.kind") < 3) | F.col("live") | (F.col("n_owners") >= example_owners))
    span = F.struct("span.start", "span.kind", "span.end", "span.value", "n_owners", "n_repos", "live")
    is_span = (F.col("span.kind") < 3) | F.col("live")
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when(is_span, span)).alias("spans"),
        F.count_if("live").alias("n_live"),
        F.count_if(F.col("n_owners") >= example_owners).alias("n_example"),
    )
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    joined = rows.join(per_row, "row", "left")
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return joined.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.coalesce(F.array_sort("spans"), empty).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
        *kept,
    )


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span replaced; spans that overlap are replaced once.

    Parts are cut from the text in four bytes a character, where a place is found without a walk; arrays are
    bound as lambda variables, so that they are made once and not for every span.
    """
    wide = F.struct(F.encode(text, "UTF-32").alias("bytes"), F.array_sort(spans).alias("spans"))

    def part(whole: Column, start: Column, end: Column | None = None) -> Column:
        size = F.octet_length(whole) if end is None else (end - start) * 4
        return F.decode(F.substring(whole, start * 4 + 1, size), "UTF-32")

    def replaced(row: Column) -> Column:
        # Where the text goes on after all spans before: the running maximum of their ends.
        ends = running(F.transform(row["spans"], lambda s: s["end"]), F.greatest)
        from_ = F.concat(F.array(F.lit(0)), ends)
        placed = F.zip_with(row["spans"], F.slice(from_, F.lit(1), F.size(row["spans"])),
                            lambda s, after: F.struct(s["start"].alias("start"), after.alias("after")))
        kept = F.filter(placed, lambda p: p["start"] >= p["after"])
        parts = F.transform(kept, lambda p: F.concat(part(row["bytes"], p["after"], p["start"]), F.lit(mask)))
        return F.concat(F.array_join(parts, ""), part(row["bytes"], F.element_at(from_, -1)))

    return F.when(F.size(spans) > 0, F.element_at(F.transform(F.array(wide), replaced), 1)).otherwise(text)


def mask_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", **options
) -> DataFrame:
    """The table with its secrets masked, copied examples left as they are; same columns, same rows.

    Spans are found by ``scan`` and brought back by (id, digest of the text): equal rows have equal spans.
    """
    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    marked = df.withColumn("__digest", digest)
    found = scan(marked, id_col, text_col, id_col, owner_col, keep=("__digest",), **options)
    example = options.get("example_owners", 3)
    found = found.select(
        F.col("doc_id").alias("__id"),
        F.col("keep___digest").alias("__found"),
        F.filter("spans", lambda s: s["n_owners"] < example).alias("__spans"),
    ).where(F.size("__spans") > 0)
    # Equal rows found the same spans; owners can differ, the union of their values cannot.
    found = found.groupBy("__id", "__found").agg(F.first("__spans").alias("__spans"))
    same = marked[id_col].eqNullSafe(found["__id"]) & (marked["__digest"] == found["__found"])
    joined = marked.join(found, same, "left")
    text = F.col(text_col).cast("string")
    masked_text = F.when(F.col("__spans").isNull(), text).otherwise(masked(text, F.col("__spans")))
    return joined.withColumn(text_col, masked_text).select(*df.columns)


__all__ = ["scan", "mask_secrets", "listed", "base_spans", "masked"]
