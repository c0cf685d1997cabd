"""URL normalisation as Column expressions.

The rules work on whole columns with built-in functions; a cheap test guards
each pattern that few links need. They are staged over
several ``select`` layers because each layer's result is read more than once;
Catalyst keeps such layers apart instead of repeating the work, and generates
one piece of code for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linktally.functions.settle import settle

# The patterns of the normalisation rules.
NOT_WEB = r"^(?i:mailto|javascript|data|tel|sms|about|blob|file):"
SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?://)?"
DEFAULT_PORT = r":(?:80|443)\z"
SHORT_SUBDOMAIN = r"^(?:(?:www|m|mobile)[.])+([^.]+[.].+)\z"
UNWANTED_PARAMETER = r"&(?:(?:utm_[a-z]+|fbclid|gclid|ref|feature)(?:=[^&]*)?)?(?=&|\z)"
INDEX_PAGE = r"/index[.][a-z]+\z"
BLANKS = "".join(chr(code) for code in range(0x21))
HOST_BLANKS = "\t\n\x0b\x0c\r "
MAX_LENGTH = (1 << 31) - 1


def _trimmed(link: Column) -> Column:
    """The link without blanks at its ends; few links have any."""
    blank = (F.substring(link, 1, 1) <= " ") | (F.substring(link, -1, 1) <= " ")
    return F.when(blank, F.btrim(link, F.lit(BLANKS))).otherwise(link)


def _web_body(trimmed: Column) -> Column:
    """A trimmed link without scheme and fragment; null if it is no web link.

    The two common schemes are cut off by length, where no further slashes follow.
    """
    bare = F.when((trimmed != "") & ~trimmed.rlike(NOT_WEB), F.regexp_replace(trimmed, SCHEME, ""))
    for scheme in ("http://", "https://"):
        common = trimmed.startswith(scheme) & ~trimmed.startswith(scheme + "//")
        bare = F.when(common, F.substring(trimmed, len(scheme) + 1, MAX_LENGTH)).otherwise(bare)
    return F.substring_index(bare, "#", 1)


def _wanted_parameters(query: Column) -> Column:
    """``&`` before every parameter that is neither empty nor a tracking one.

    One pattern for the whole text; filtering a list with a lambda would take
    the projection out of generated code.
    """
    cleaned = F.regexp_replace(F.concat(F.lit("&"), query), UNWANTED_PARAMETER, "")
    return F.when(query == "", "").otherwise(cleaned)


def _clean_query(wanted: Column) -> Column:
    """``?`` and the sorted parameters, or ``''`` when there is none."""
    ordered = F.sort_array(F.split(F.substr(wanted, F.lit(2)), "&"))
    return F.when(wanted == "", "").otherwise(F.concat(F.lit("?"), F.array_join(ordered, "&")))


def _host(authority: Column) -> Column:
    """Lower case, without user and default port."""
    host = F.lower(F.substring_index(authority, "@", -1))
    return F.when(host.contains(":"), F.regexp_replace(host, DEFAULT_PORT, "")).otherwise(host)


def _clean_path(path: Column) -> Column:
    named = F.when(path.contains("/index."), F.regexp_replace(path, INDEX_PAGE, "")).otherwise(path)
    return F.when(named.endswith("/"), F.rtrim(named, F.lit("/"))).otherwise(named)


def _valid_host(host: Column) -> Column:
    """Is there a host, without white space? What ends a host is cut off before."""
    valid = host != ""
    for blank in HOST_BLANKS:
        valid = valid & ~host.contains(blank)
    return valid


def _short_host(host: Column) -> Column:
    starts = host.startswith("www.") | host.startswith("m.") | host.startswith("mobile.")
    return F.when(starts, F.regexp_replace(host, SHORT_SUBDOMAIN, "$1")).otherwise(host)


def with_normalized_url(
    df: DataFrame,
    link: str = "link",
    output: str = "normalized_url",
    host: str | None = None,
) -> DataFrame:
    """Add the normalised form of ``link`` as ``output`` and, if asked for, its
    host (lower case, without user and port, subdomains kept) as ``host``.

    Both are null where the link is not a valid web link.
    """
    keep = df.columns
    staged = (
        df.withColumn("_trimmed", _trimmed(F.col(link)))
        .withColumn("_body", _web_body(F.col("_trimmed")))
        .withColumn("_head", F.substring_index("_body", "?", 1))
        .withColumns(
            {
                "_query": _wanted_parameters(F.substr("_body", F.length("_head") + 2)),
                "_authority": F.substring_index("_head", "/", 1),
            }
        )
        .withColumns(
            {
                "_path": F.substr("_head", F.length("_authority") + 1),
                "_host": _host(F.col("_authority")),
            }
        )
        .withColumn("_host", F.when(_valid_host(F.col("_host")), F.col("_host")))
    )
    normalized = F.concat(
        _short_host(F.col("_host")),
        _clean_path(F.col("_path")),
        _clean_query(F.col("_query")),
    )
    outputs = [normalized.alias(output)]
    if host:
        outputs.append(F.substring_index("_host", ":", 1).alias(host))
    return settle(staged.select(*keep, *outputs), *([output, host] if host else [output]))
