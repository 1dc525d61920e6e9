"""URL filter: domain rules first, then a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import map_rows

# A rule is (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# One strict term rejects; distinct soft terms add up. Words that ordinary sites use as well weigh
# 1, those that seldom stand for anything else 2, so none rejects by itself.
STRICT = ("porn", "xxx", "sex", "adult", "escort", "casino", "viagra", "warez", "malware")
_ORDINARY = (
    "ads", "bonus", "cheap", "click", "deal", "farm", "free", "loan", "promo", "track", "win",
    "winner",
)
_TELLING = (
    "bet", "bets", "cialis", "gamble", "jackpot", "lottery", "pharmacy", "pill", "pills", "poker",
    "slots", "spam", "tracker",
)
SOFT = dict.fromkeys(_ORDINARY, 1) | dict.fromkeys(_TELLING, 2)
LIMIT = 3

_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule for this host, or a domain above it, whose path starts the url's path."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda pair: len(pair[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        found = F.when(
            fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        ).otherwise(found)
    return found


# Escapes of letters and what they stand for once A-Z is in lower case, in the order of decoding.
ESCAPED_LETTERS = [(f"%{ord(c):x}", c) for c in _LOWER] + [
    (f"%{ord(c):x}", c.lower()) for c in _UPPER
]
_EDGE = frozenset(_LOWER + "0123456789")


def searched_text(url: str | None) -> str:
    """The whole url, A-Z in lower case and escaped ASCII letters decoded."""
    text = (url or "").encode().lower().decode()
    if "%" in text:
        for escape, letter in ESCAPED_LETTERS:
            text = text.replace(escape, letter)
    return text


def terms_in(automaton, text: str) -> set[str]:
    """Terms of the vocabulary in ``text`` with none of a-z and 0-9 right before or after."""
    found = set()
    for end, term in automaton.iter(text):
        start = end - len(term) + 1
        before, after = text[start - 1 : start], text[end + 1 : end + 2]
        if before not in _EDGE and after not in _EDGE:
            found.add(term)
    return found


def judge_urls(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Mapping[str, int] = SOFT,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, strict_terms, soft_terms.

    The fitting rule decides. Where none fits, the whole url, query and fragment included, is
    searched for terms, A-Z in lower case and escaped letters decoded: one strict term, or
    distinct soft terms whose weights reach ``limit``, give ``block``, anything else ``allow``.
    Term lists are sorted and empty under a rule.

    A url without ``://`` has empty host and path and fits no rule, but is searched; a null or
    empty one is allowed. Very long urls are searched whole. Of fitting rules of equal length
    the later one counts. Repeated rows give repeated results, an empty table none; other columns
    are not read, whatever their names. No shuffle.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    parts = pages.select(
        F.col(key).alias("k"),
        host.alias("h"),
        path.alias("p"),
        F.col(url).alias("u"),
    ).withColumn("r", fitting_rule(F.col("h"), F.col("p"), rules))
    strict_terms, weights = frozenset(strict), dict(soft)

    def search():
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in {*strict_terms, *weights}:
            automaton.add_word(term, term)
        if len(automaton):
            automaton.make_automaton()

        def row(k, h, p, u, verdict, rule):
            if rule is not None or not len(automaton):
                return [(k, h, p, rule, verdict or "allow", [], [])]
            terms = terms_in(automaton, searched_text(u))
            hard = sorted(terms & strict_terms)
            light = sorted(terms & weights.keys())
            blocked = bool(hard) or sum(weights[term] for term in light) >= limit
            return [(k, h, p, None, "block" if blocked else "allow", hard, light)]

        return row

    kind = dict(pages.dtypes)[key]
    judged = map_rows(
        parts.select("k", "h", "p", "u", "r.verdict", "r.rule"),
        search,
        f"k {kind}, host string, path string, rule string, verdict string, "
        "strict_terms array<string>, soft_terms array<string>",
    )
    return judged.withColumnRenamed("k", key)
