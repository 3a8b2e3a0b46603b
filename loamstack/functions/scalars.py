"""Scalar expressions. All are built-ins, so they stay in whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_count(text: Column) -> Column:
    """Parts between newlines; a trailing newline opens an empty last part. NULL stays NULL (size() alone would give -1)."""
    return F.when(text.isNotNull(), F.size(F.split(text, "\n")))


def byte_count(text: Column) -> Column:
    return F.octet_length(text)


def content_hash(text: Column) -> Column:
    """SHA-256 in lower-case hex of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def clean_language(text: Column) -> Column:
    """First language of a share list: `Rust 80% C 5%` -> `Rust`. NULL stays NULL. The rule for names of several words is ours."""
    return F.regexp_extract(F.trim(text), r"^(.*?)(?:\s+\d+(?:\.\d+)?%.*)?$", 1)


def language_key(text: Column) -> Column:
    """Language label without regard to letter case and blanks."""
    return F.lower(F.trim(text))


def token_count(text: Column) -> Column:
    """Non-empty parts between white space."""
    return F.when(text.isNotNull(), F.size(F.filter(F.split(text, r"\s+"), lambda x: x != "")))


def heuristic_score(text: Column) -> Column:
    """lines * 10 + characters * 2."""
    return line_count(text) * 10 + F.length(text) * 2


def micros_between(since: Column, until: Column) -> Column:
    """Microseconds between two times without zone; the session's zone plays no part."""
    d = until.cast("timestamp_ntz") - since.cast("timestamp_ntz")
    whole = (F.extract(F.lit("DAY"), d) * 24 + F.extract(F.lit("HOUR"), d)) * 60 + F.extract(F.lit("MINUTE"), d)
    return whole.cast("bigint") * 60_000_000 + (F.extract(F.lit("SECOND"), d) * 1_000_000).cast("bigint")


def ntz_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a time without zone."""
    return micros_between(F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), ts)


def ntz_time(micros: Column) -> Column:
    """The time without zone of so many microseconds since 1970."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=(micros / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)"))


def seconds_between(since: Column, until: Column) -> Column:
    """Elapsed seconds as a double."""
    return micros_between(since, until) / 1e6


def time_bucket(ts: Column, seconds: int) -> Column:
    """Start of the bucket of that many seconds, counted from 1970."""
    us = seconds * 1_000_000
    return ntz_time(ntz_micros(ts) - F.pmod(ntz_micros(ts), F.lit(us)))


def age_days(since: Column, as_of: Column) -> Column:
    """Whole 24-hour days between; 0 where `since` is unknown."""
    return F.coalesce(F.floor(micros_between(since, as_of) / 86_400_000_000), F.lit(0).cast("bigint"))


def now() -> Column:
    """The time without zone at which a query runs; queries that must repeat take an `as_of` instead."""
    return F.localtimestamp()


def alternative(x: Column, default: str) -> Column:
    """`default` where `x`, a field read from JSON, is missing, null or false."""
    return F.when(x.isNull() | x.isin("null", "false"), F.lit(default)).otherwise(x)


def backoff_seconds(attempt: Column, initial: float, factor: float, cap: float) -> Column:
    """Exponential back-off without jitter."""
    return F.least(F.lit(initial) * F.pow(F.lit(factor), attempt), F.lit(cap))


def or_default(text: Column, default: str) -> Column:
    """NULL and the empty string become `default`."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def round_half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def elapsed_mmss(seconds: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(seconds / 60).cast("int"), (seconds % 60).cast("int"))


def percent(x: Column) -> Column:
    return F.format_string("%.2f%%", (x * 100).cast("double"))


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def field(text: Column, n: int) -> Column:
    """n-th field (from 1) between white space; NULL where there are fewer."""
    return F.get(F.split(F.trim(text), r"\s+"), F.lit(n - 1))


def canonical_repo(name: Column) -> Column:
    """`owner/name` in lower case from any spelling: URL, ssh form, letter case, blanks, `.git`, slashes at the end."""
    x = F.lower(F.trim(F.regexp_replace(name, r"[\s ]+", " ")))
    x = F.regexp_replace(x, r"^(?:[a-z][a-z0-9+.-]*://)(?:[^/@]*@)?[^/]+/+|^[^/@:\s]+@[^/:]+:/*", "")
    return F.regexp_replace(F.regexp_replace(x, r"[?#].*$", ""), r"(?:\.git)?/*$", "")


def series_key(labels: Column) -> Column:
    """A map of labels as one comparable string, keys in order; NULL labels give the empty string."""
    pairs = F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.coalesce(F.array_join(F.array_sort(pairs), ","), F.lit(""))
