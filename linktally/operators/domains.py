"""Domain attribution by lookups in a suffix table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linktally.functions.settle import settle
from linktally.functions.suffixes import DEEPER, EXACT, EXCEPTION, WILDCARD, SuffixRules

# The other full stops that a host of letters may be written with.
FULL_STOPS = "\u3002\uff0e\uff61"
# Line ends: "$" of a pattern matches before one at the end of a text, too.
LINE_ENDS = "\n\r\u0085\u2028\u2029"


def _dotted(host: Column) -> Column:
    """The host with ASCII full stops; few hosts have others."""
    other = reduce(or_, [host.contains(stop) for stop in FULL_STOPS])
    return F.when(other, F.translate(host, FULL_STOPS, "." * len(FULL_STOPS))).otherwise(host)


def _without_last_dot(host: Column) -> Column:
    ends = reduce(or_, [host.endswith(end) for end in "." + LINE_ENDS])
    return F.when(ends, F.regexp_replace(host, r"[.]$", "")).otherwise(host)


def attribute_domain(
    df: DataFrame, rules: SuffixRules, host: str = "host", output: str = "domain_name"
) -> DataFrame:
    """Add the registered domain of ``host``: its longest suffix and one label.

    One lookup by the host's last label, in a small table whose size was checked when
    it was made, brings all rules that can hold for it: rows are neither
    multiplied nor shuffled, however many labels rules have. Suffixes of three labels or
    more are looked for only below two labels that have such rules.
    Under no rule the last label is the suffix, as the public list prescribes. One
    dot at the end of a host is left out. The result is null for an address, a
    single label or a bare suffix. Rules hold for both spellings of a label, letters and ``xn--``;
    the domain is spelled as the host is.
    """
    keep = df.columns
    given, host = host, "_named_host"
    df = df.withColumn("_dotted_host", _dotted(F.col(given))).withColumn(host, _without_last_dot(F.col("_dotted_host")))
    dots = F.length(host) - F.length(F.replace(F.col(host), F.lit("."), F.lit("")))
    entries = rules.frame.select(
        F.col("last").alias("_last"), F.col("flags").alias("_flags1"), F.col("pairs").alias("_pairs"), F.col("deeper").alias("_deeper")
    )
    joined = df.withColumn("_labels", dots + 1).join(
        F.broadcast(entries), F.substring_index(host, ".", -1) == F.col("_last"), "left"
    )

    def looked_up(table, size):
        suffix = F.when(F.col("_labels") >= size, F.substring_index(host, ".", -size))
        return F.try_element_at(table, suffix).cast("int").alias(f"_flags{size}")

    flags = [f"_flags{size}" for size in range(2, rules.depth + 1)]
    found_two = joined
    if rules.depth > 1:
        found_two = settle(joined.select("*", looked_up("_pairs", 2)), "_flags2")
    if rules.depth > 2:
        below = F.when(F.col("_flags2").bitwiseAND(DEEPER) != 0, F.col("_deeper"))
        longer = [looked_up(below, size) for size in range(3, rules.depth + 1)]
        found_two = settle(found_two.select("*", *longer), *flags[1:])
    looked_up_all = found_two

    def has(size, flag):
        return F.col(f"_flags{size}").bitwiseAND(flag) != 0

    sizes = range(rules.depth, 0, -1)
    # A rule "!a.b" says that the suffix is "b"; exceptions win over other rules.
    found = [(has(size, EXCEPTION), size - 1) for size in sizes]
    for size in range(rules.depth + 1, 0, -1):
        if size > 1:
            found.append((has(size - 1, WILDCARD) & (F.col("_labels") >= size), size))
        if size <= rules.depth:
            found.append((has(size, EXACT), size))
    domain = None
    for condition, size in found:
        registered = F.when(F.col("_labels") > size, F.substring_index(host, ".", -(size + 1)))
        domain = F.when(condition, registered) if domain is None else domain.when(condition, registered)
    # the prevailing rule; an address ends in digits or a bracket
    plain = (F.col("_labels") > 1) & ~F.col(host).rlike(r"(?:^|[.])[0-9]*$|[\[\]:]")
    domain = domain.when(plain, F.substring_index(host, ".", -2))
    named = looked_up_all.withColumn("_domain", domain)
    complete = F.when(~F.col("_domain").startswith("."), F.col("_domain"))
    return named.select(*keep, complete.alias(output))
