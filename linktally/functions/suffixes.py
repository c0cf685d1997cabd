"""Public-suffix rules, the data behind domain attribution."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from string import ascii_lowercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXACT, WILDCARD, EXCEPTION = 1, 2, 4
#: Marks two labels below which there are rules of more labels.
DEEPER = 8

# The published list has about 10,000 rules. The table is broadcast, so more than this raises.
MOST_RULES = 200_000

# Generic top-level domains and common second-level suffixes.
GENERIC = """
com org net edu gov mil int info biz name pro museum coop aero jobs mobi travel tel cat asia post xxx
app dev page blog shop store online site website tech space live news media world today life club
wiki cloud email link digital agency art audio beer berlin bio black blue cafe camp care center
chat church city codes coffee community company cool design directory earth energy events expert
family fashion fit fun fund gallery game games global gold green group guide guru health help host
house icu international land law london love ltd market men money music network ninja one paris
party photo photos pizza plus press red rocks run sale school science social solutions stream studio
style support team theater tips tools top tours town trade tube tv vip watch wine work works wtf xyz zone
""".split()
# Second levels that any country may have, and those of single countries.
ANY_COUNTRY = "ac co com edu gov mil net org".split()
SECOND_LEVEL = {
    "ad": "jp",
    "asn": "au",
    "asso": "fr",
    "ed": "cr jp",
    "gen": "in nz tr",
    "go": "cr id jp ke kr th tz ug",
    "gob": "ar bo cl ec es gt hn mx pa pe sv ve",
    "gouv": "fr ci ml sn",
    "govt": "nz",
    "gr": "jp",
    "id": "au",
    "ind": "br in",
    "lg": "jp",
    "ltd": "uk",
    "me": "ke tz uk",
    "ne": "jp ke kr ug",
    "nhs": "uk",
    "nom": "br co es fr",
    "or": "at cr id jp ke kr mu th tz ug",
    "pe": "kr",
    "plc": "uk",
    "police": "uk",
    "re": "kr",
    "sch": "id uk",
    "school": "nz za",
    "web": "id tr ve za",
}
HOSTING = ("github.io", "gitlab.io", "blogspot.com", "herokuapp.com", "netlify.app", "vercel.app")
SPECIAL = ("*.ck", "!www.ck", "公司.cn", "网络.cn", "網絡.cn", "公司.hk", "個人.hk", "組織.hk")


@dataclass(frozen=True)
class SuffixRules:
    """Suffix rules ready to join, with one row per last label.

    A row has the ``flags`` of that label alone, and maps to flags: ``pairs`` from
    suffixes of two labels, ``deeper`` from longer ones. ``depth`` is the label count
    of the longest. The number of rules has been checked against ``MOST_RULES``.
    """

    frame: DataFrame
    depth: int


def _checked(rows: int) -> None:
    if rows > MOST_RULES:
        raise ValueError(f"{rows} suffix rules: at most {MOST_RULES} can be broadcast")


def _entry(rule: str) -> tuple[str, int]:
    if rule.startswith("!"):
        return rule[1:], EXCEPTION
    if rule.startswith("*."):
        return rule[2:], WILDCARD
    return rule, EXACT


def _spellings(label: str) -> list[str]:
    """A label as it is, and in the other of its two spellings: letters, or ``xn--`` and ASCII."""
    try:
        if not label.isascii():
            return [label, "xn--" + label.encode("punycode").decode("ascii")]
        if label.startswith("xn--"):
            return [label, label[4:].encode("ascii").decode("punycode")]
    except UnicodeError:
        pass
    return [label]


def rule_flags(rules) -> dict[str, int]:
    """Suffix -> flags for rules in the notation of the public list, in every spelling of their labels."""
    flags: dict[str, int] = {}
    for rule in rules:
        written, flag = _entry(rule.lower())
        for labels in product(*[_spellings(label) for label in written.split(".")]):
            suffix = ".".join(labels)
            flags[suffix] = flags.get(suffix, 0) | flag
    return flags


def default_rules() -> list[str]:
    """A compact rule list. Every two-letter label counts as a country's.

    The published list is longer and exact: :func:`read_suffix_rules` takes it.
    """
    countries = [first + second for first in ascii_lowercase for second in ascii_lowercase]
    seconds = [f"{label}.{tld}" for label, tlds in SECOND_LEVEL.items() for tld in tlds.split()]
    general = [f"{label}.{country}" for country in countries for label in ANY_COUNTRY]
    return [*dict.fromkeys([*GENERIC, *countries, *general, *seconds, *HOSTING, *SPECIAL])]


def _rows(flags: dict[str, int]) -> list[str]:
    """A line of text per last label: the label, its flags, and those of longer suffixes."""
    pairs: dict[str, dict[str, int]] = {}
    deeper: dict[str, dict[str, int]] = {}
    for suffix, flag in flags.items():
        labels = suffix.split(".")
        own = pairs.setdefault(labels[-1], {})
        two = ".".join(labels[-2:])
        if len(labels) == 2:
            own[two] = own.get(two, 0) | flag
        elif len(labels) > 2:
            own[two] = own.get(two, 0) | DEEPER
            deeper.setdefault(labels[-1], {})[suffix] = flag

    def listed(found: dict[str, int]) -> str:
        return ";".join(f"{suffix}={flag}" for suffix, flag in found.items())

    return [f"{last}:{flags.get(last, 0)}:{listed(own)}:{listed(deeper.get(last, {}))}" for last, own in pairs.items()]


def suffix_rules(spark: SparkSession, rules=None, extra=()) -> SuffixRules:
    """Rules from a Python list (the built-in one by default) plus ``extra`` ones."""
    flags = rule_flags([*(default_rules() if rules is None else rules), *extra])
    _checked(len(flags))
    entry = F.split("entry", ":")
    frame = (
        spark.range(0, 1, 1, 1)
        .select(F.explode(F.split(F.lit(" ".join(_rows(flags))), " ")).alias("entry"))
        .select(
            entry[0].alias("last"),
            entry[1].cast("int").alias("flags"),
            F.str_to_map(entry[2], F.lit(";"), F.lit("=")).alias("pairs"),
            F.str_to_map(entry[3], F.lit(";"), F.lit("=")).alias("deeper"),
        )
    )
    return SuffixRules(frame, max((suffix.count(".") + 1 for suffix in flags), default=1))


def read_suffix_rules(spark: SparkSession, path: str) -> SuffixRules:
    """Rules from a file in the notation of the public list (``//`` comments)."""
    rule = F.lower(F.regexp_extract("value", r"^\s*(\S+)", 1))
    lines = spark.read.text(path).select(rule.alias("rule")).where((F.col("rule") != "") & ~F.col("rule").startswith("//"))
    rules = [row["rule"] for row in lines.distinct().limit(MOST_RULES + 1).collect()]
    if not rules:
        raise ValueError(f"no suffix rule in {path}")
    _checked(len(rules))
    return suffix_rules(spark, rules)
