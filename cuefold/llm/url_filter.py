"""URL filter: host/path rules first, then a weighted vocabulary matched by Aho-Corasick.

A term counts where it stands between characters other than a-z and 0-9. A page is rejected on one
strict term, or when two or more distinct soft terms weigh SOFT_LIMIT or more together: two light terms
(weight 1 each) don't, a light and a heavy one do, and so do three light ones. One soft term alone never
rejects, however often it occurs. The vocabulary is an argument; `vocabulary` reads it from a table.

Defined results: a null or schemeless url has empty host and path and is allowed; repeated rows are
judged each; an empty table gives an empty one. Input columns beyond the id and the url are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuefold.llm.batches import map_batches

# This operator's vocabulary and rules.
STRICT = ("adult", "casino", "escort", "hentai", "porn", "spam", "viagra", "xxx")
SOFT = {
    "ads": 1, "bet": 2, "bets": 2, "betting": 2, "bonus": 1, "cheap": 1, "crack": 2, "farm": 1, "free": 1, "gambling": 2, "jackpot": 2, "keygen": 2,
    "loan": 1, "lottery": 2, "nude": 2, "pharma": 2, "pills": 2, "poker": 2, "popup": 1, "sex": 2, "slots": 2, "track": 1, "warez": 2, "win": 1,
}
SOFT_LIMIT = 3
MAX_TERMS = 1_000_000
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host with A-Z lowered and path; both empty without a scheme."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    slash = rest.find("/", 0, cut)
    if slash < 0:
        return rest[:cut].translate(_AZ), ""
    return rest[:slash].translate(_AZ), rest[slash:cut]


class Rules:
    """Host/path rules; the longest that fits decides. A url's host has as many lookups as labels."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules:
            host, _, path = rule.partition("/")
            self.by_host.setdefault(host, []).append(("/" + path, rule, verdict))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        best: tuple[str, str] | None = None
        suffix = host
        while suffix:
            for start, rule, verdict in self.by_host.get(suffix, ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            suffix = suffix.partition(".")[2]
        return best


class Vocabulary:
    """Strict terms and weighted soft terms in one automaton."""

    def __init__(self, strict: tuple[str, ...], soft: dict[str, int], limit: int):
        self.limit = limit
        self.automaton = ahocorasick.Automaton()
        for term, weight in {**soft, **dict.fromkeys(strict, 0)}.items():
            self.automaton.add_word(term, (term, weight))
        self.automaton.make_automaton()

    def hits(self, url: str) -> tuple[int, int, int]:
        """Strict hits, distinct soft terms and their weight."""
        low, strict, soft = url.translate(_AZ), 0, {}
        for end, (term, weight) in self.automaton.iter(low):
            start = end - len(term)
            if (start >= 0 and low[start] in _WORD) or (end + 1 < len(low) and low[end + 1] in _WORD):
                continue
            if weight:
                soft[term] = weight
            else:
                strict += 1
        return strict, len(soft), sum(soft.values())

    def blocks(self, strict: int, distinct: int, weight: int) -> bool:
        return strict > 0 or (distinct > 1 and weight >= self.limit)


def vocabulary(terms: DataFrame, term_col: str = "term", weight_col: str = "weight", most: int = MAX_TERMS) -> tuple[tuple[str, ...], dict[str, int]]:
    """Strict terms (null weight) and soft terms with weights of a table; of repeats a null or else the greatest weight counts.

    A vocabulary is configuration that every worker holds: more than `most` terms raise."""
    low = F.lower(F.trim(terms[term_col].cast("string"))).alias("term")
    rows = terms.select(low, terms[weight_col].cast("int").alias("weight")).where(F.col("term") != "")
    found = rows.groupBy("term").agg(F.bool_or(F.col("weight").isNull()).alias("strict"), F.max("weight").alias("weight")).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} terms")
    return tuple(sorted(r.term for r in found if r.strict)), {r.term: r.weight for r in sorted(found) if not r.strict}


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict=STRICT, soft=SOFT, limit: int = SOFT_LIMIT
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, strict_hits, soft_hits, soft_weight."""
    slim = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"))
    kind = slim.schema["page_id"].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule_set, words = Rules(rules), Vocabulary(strict, soft, limit)
        for batch in batches:
            hosts, paths, found, verdicts, counts = [], [], [], [], []
            for url in batch.column(1).to_pylist():
                host, path = host_and_path(url)
                rule = rule_set.match(host, path)
                hit = words.hits(url or "")
                hosts.append(host)
                paths.append(path)
                found.append(rule[0] if rule else None)
                verdicts.append(rule[1] if rule else "block" if words.blocks(*hit) else "allow")
                counts.append(hit)
            strings = [pa.array(x, pa.string()) for x in (hosts, paths, found, verdicts)]
            numbers = [pa.array([c[i] for c in counts], pa.int32()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *strings, *numbers], ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "soft_weight"]
            )

    return map_batches(
        slim, judged, f"page_id {kind}, host string, path string, rule string, verdict string, strict_hits int, soft_hits int, soft_weight int"
    )


def oracle() -> str:
    """The same in DuckDB: one regular expression for each term."""
    low = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    has = lambda term: f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"
    count = lambda term: (
        f"len(list_filter(generate_series(1, length(low)), lambda i: substr(low, i, {len(term)}) = '{term}'"
        f" AND NOT regexp_matches(CASE WHEN i > 1 THEN substr(low, i - 1, 1) ELSE '' END, '[a-z0-9]')"
        f" AND NOT regexp_matches(substr(low, i + {len(term)}, 1), '[a-z0-9]')))"
    )
    cases = []
    for rule, verdict in sorted(RULES, key=lambda r: -len(r[0])):
        host, _, path = rule.partition("/")
        cases.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", rule, verdict))
    whens = lambda i: " ".join(f"WHEN {c[0]} THEN '{c[i]}'" for c in cases)
    return f"""
WITH u AS (SELECT page_id, {low} AS low, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
  CAST({" + ".join(count(t) for t in STRICT)} AS INTEGER) AS strict_hits,
  CAST({" + ".join(f"{has(t)}::INT" for t in SOFT)} AS INTEGER) AS soft_hits,
  CAST({" + ".join(f"{w} * {has(t)}::INT" for t, w in SOFT.items())} AS INTEGER) AS soft_weight FROM u)
SELECT page_id, host, path, CASE {whens(1)} END AS rule,
  CASE {whens(2)} WHEN strict_hits > 0 OR (soft_hits > 1 AND soft_weight >= {SOFT_LIMIT}) THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_hits, soft_weight FROM p"""
