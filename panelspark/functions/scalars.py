"""Column expressions: dates, money, bands, ranks, hashes. All run in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: inclusive upper bounds and labels of day and money bands
DAY_BANDS = [(7, "0-7"), (30, "8-30"), (90, "31-90"), (365, "91-365"), (None, "over 365")]
MONEY_BANDS = [(1000, "to 1000"), (5000, "to 5000"), (10000, "to 10000"), (50000, "to 50000"), (None, "over 50000")]
#: Size suffixes, longest first.
SIZES = {"Ki": 2.0**10, "Mi": 2.0**20, "Gi": 2.0**30, "m": 1e-3, "k": 1e3, "M": 1e6, "G": 1e9}


def us_date(text: Column) -> Column:
    """month/day/year in the first ten characters; null if it isn't one."""
    return F.try_to_timestamp(F.substring(F.trim(text), 1, 10), F.lit("M/d/yyyy")).cast("date")


def iso_date(text: Column) -> Column:
    """Date of ISO text with at least ten characters; null if it isn't one."""
    return F.when(F.length(text) >= 10, F.left(text, F.lit(10)).try_cast("date"))


def money(text: Column) -> Column:
    """Number of a text with dollar signs and thousands separators; null if it isn't one."""
    return F.translate(text, "$,", "").try_cast("double")


def age_on(birth: Column, day: Column) -> Column:
    """Full years on a day; born on 29 February, one is older from 1 March on in other years."""
    before = (F.month(day) < F.month(birth)) | ((F.month(day) == F.month(birth)) & (F.dayofmonth(day) < F.dayofmonth(birth)))
    return F.year(day) - F.year(birth) - F.when(before, 1).otherwise(0)


def band(value: Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    """Label of the first band whose upper bound holds the value, the first band beginning at 0; null below it."""
    out = F.lit(None).cast("string")
    for high, label in reversed(bands):
        out = F.lit(label) if high is None else F.when(value <= high, label).otherwise(out)
    return F.when(value >= 0, out)


def most_serious(codes: Column, ranking: Sequence[str], fallback: str) -> Column:
    """The code that stands first in the ranking; the fallback if none does."""
    rank = F.create_map(*[x for i, c in enumerate(ranking) for x in (F.lit(c), F.lit(i))])
    least = F.array_min(F.transform(codes, lambda c: F.try_element_at(rank, c)))
    return F.coalesce(F.try_element_at(F.array(*map(F.lit, ranking)), least + 1), F.lit(fallback))


def set_status(items: Column, test) -> Column:
    """all, some, none or empty: how many items of an array pass a test."""
    return F.when(F.size(items) <= 0, "empty").when(F.forall(items, test), "all").when(F.exists(items, test), "some").otherwise("none")


def only_reason(flags: Column, amount: Column, test) -> Column:
    """The amount where every item passes the test and there is one, else null."""
    return F.when((F.size(flags) > 0) & F.forall(flags, test), amount)


def local_date(instant: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def local_label(instant: Column, zone: str) -> Column:
    return F.date_format(F.from_utc_timestamp(instant, zone), "MMM dd, hh:mm a")


def squeezed(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def number_in(text: Column, pattern: str, group: int = 1) -> Column:
    """A number with thousands separators found by a pattern."""
    return F.replace(F.regexp_extract(text, pattern, group), F.lit(","), F.lit("")).try_cast("bigint")


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the row's columns in name order as JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def padded_id(number: Column, width: Column | int) -> Column:
    """A number as text with leading zeros up to a width; longer ones are not cut."""
    s = number.cast("bigint").cast("string")
    return F.lpad(s, F.greatest(F.length(s), F.lit(width) if isinstance(width, int) else width), F.lit("0"))


def is_heading(columns: Sequence[str]) -> Column:
    """Whether a row's values are the columns' names."""
    pairs = F.zip_with(F.array(*[F.col(c).cast("string") for c in columns]), F.array(*map(F.lit, columns)), lambda a, b: a.eqNullSafe(b))
    return F.forall(pairs, lambda x: x)


def looked_up(key: Column, values: dict[str, str], default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key), F.lit(default))


def error_class(text: Column) -> Column:
    """Only the class name at the head of an error text."""
    return F.regexp_extract(text, r"^([A-Za-z_][A-Za-z0-9_.]*)", 1)


def size_number(text: Column) -> Column:
    """A number with a size suffix: 250m is 0.25, 512Mi is 536870912; null if it isn't one."""
    suffix = F.regexp_extract(text, r"^[0-9.]+([A-Za-z]*)$", 1)
    factor = F.when(suffix == "", F.lit(1.0))
    for k, v in SIZES.items():
        factor = factor.when(suffix == k, F.lit(v))
    return F.regexp_extract(text, r"^([0-9.]+)", 1).try_cast("double") * factor


def set_relation(a: Column, b: Column) -> Column:
    """How two arrays relate as sets: missing, identical, subset, superset, overlap or disjoint."""
    left, right = F.size(F.array_except(a, b)), F.size(F.array_except(b, a))
    return (
        F.when(a.isNull() | b.isNull() | (F.size(a) == 0) | (F.size(b) == 0), "missing")
        .when((left == 0) & (right == 0), "identical")
        .when(left == 0, "subset")
        .when(right == 0, "superset")
        .when(F.arrays_overlap(a, b), "overlap")
        .otherwise("disjoint")
    )


def suppressed(count: Column, least: int = 10) -> Column:
    """A count for publication: small ones show only that they are small, zero stays."""
    return F.when(count.between(1, least - 1), F.lit(f"<{least}")).otherwise(count.cast("string"))


def shown_share(part: Column, whole: Column, least: int = 10) -> Column:
    """part / whole where the part is large enough and the whole not 0."""
    return F.when(part >= least, F.try_divide(part, whole))
