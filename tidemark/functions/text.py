"""String parsing as built-in column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def url_domain(url: Column) -> Column:
    """What follows the second dot-separated label; anything with '.com' is 'com'.

    Both labels need at least one character. Without a second dot: null.
    """
    rest = F.regexp_extract(url, r"^.+?\..+?\.([\s\S]*)$", 1)
    found = url.rlike(r"^.+?\..+?\.")
    return F.when(found, F.when(rest.contains(".com"), F.lit("com")).otherwise(rest))


def main_url(url: Column) -> Column:
    """Scheme and host (greedy to the last '//'), null without a slash after it."""
    found = F.regexp_extract(url, r"^(.*//.*?)/", 1)
    return F.when(found != "", found)


def file_name(path: Column) -> Column:
    """After the last slash; null without one."""
    return F.when(path.contains("/"), F.regexp_extract(path, r"([^/]*)$", 1))


def file_type(path: Column) -> Column:
    """After the last dot, else 'no file type'."""
    return F.when(path.contains("."), F.regexp_extract(path, r"([^.]*)$", 1)).otherwise(F.lit("no file type"))


def version_token(path: Column) -> Column:
    """Longest run of digits joined by . _ - (first on ties), null without a digit."""
    runs = F.regexp_extract_all(path, F.lit(r"([0-9][0-9._-]*)"), F.lit(1))
    return F.aggregate(
        runs,
        F.lit(None).cast("string"),
        lambda best, run: F.when(best.isNull() | (F.length(run) > F.length(best)), run).otherwise(best),
    )


def version_number(version: Column) -> Column:
    """First digit, a point, the remaining digits; 0 when that cannot be read."""
    rest = F.regexp_replace(F.substring(version, 2, 1_000_000), "[-_.]", "")
    joined = F.concat(F.substring(version, 1, 1), F.lit("."), rest)
    return F.when(F.coalesce(rest, F.lit("")) == "", F.lit(0.0)).otherwise(
        F.coalesce(joined.try_cast("double"), F.lit(0.0))
    )


def phone_status(phone: Column) -> Column:
    """Shape rule for international numbers; 'unknown' means none was given."""
    return (
        F.when(phone == "unknown", F.lit("Phone number was not provided"))
        .when(phone.rlike(r"^\+[1-9][0-9]{6,14}$"), F.lit("valid"))
        .otherwise(F.lit("invalid"))
    )


def activity_name(reason: Column) -> Column:
    """'<a>.<b> action change' (any case) -> '<b>' lower-cased, else the text itself."""
    low = F.lower(reason)
    found = low.rlike(r"^.*?\..*? action change")
    return F.when(found, F.regexp_extract(low, r"^(.*?)(\.)(.*?)( action change)", 3)).otherwise(reason)


def sha1_id(text: Column) -> Column:
    return F.sha1(text)
