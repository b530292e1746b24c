"""URL filters: host/path rules, then a weighted vocabulary by Aho-Corasick.

One automaton holds all strict and soft terms; one pass over a url finds every
occurrence.  An occurrence counts if no letter or digit touches it, so ``bet``
is not found in ``alphabet``; a term lists its inflected forms, which count as
one.  A url is blocked on one strict term or on ``soft_limit`` distinct soft
ones.  Rules overrule the vocabulary.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

def compounds(first: str, second: str) -> str:
    """Every word of ``first`` with every word of ``second`` as one term: run
    together, or with ``-``, ``_`` or ``.`` between."""
    return " ".join(f"{a}{mark}{b}" for a in first.split() for b in second.split() for mark in ("", "-", "_", "."))


#: A term is its forms with blanks between; forms of one term count once.
#: General terms, no host names.  ``adult``, ``ads``, ``track`` and ``spam``
#: alone are harmless (adult-education, free-ads, spam-free), so they are
#: strict only beside a word that makes the trade plain.
STRICT = ("casino", "porn porno pornos", "xxx", "viagra", "cialis", "levitra", "kamagra", "escort escorts",
          "warez", "malware", "hentai", "milf milfs", "camgirl camgirls", "x-rated xrated", "keygen keygens",
          compounds("adult adults", "x xx only cam cams chat content dating film films movie movies personals pics "
                                    "shop site sites tube video videos"),
          compounds("ad ads", "click clicks network networks server servers serving track tracker trackers tracking"),
          compounds("spam", "blog blogs bot bots domain domains farm farms host hosts link links network networks "
                            "page pages site sites"),
          compounds("content link links", "farm farms"), "splog splogs")
#: ``casinos`` alone passes, ``casino`` does not
SOFT = ("adult adults", "bet bets betting bettor bettors", "blackjack", "bonus bonuses", "casinos", "cheap cheaper cheapest",
        "crack cracks cracked", "dating", "free", "gamble gambler gamblers gambling", "hookup hookups",
        "jackpot jackpots", "loan loans", "lottery lotteries lotto", "nude nudes", "payday", "pill pills", "poker",
        "popunder popunders", "replica replicas", "roulette", "sex sexy", "slots", "spammer spammers",
        "torrent torrents", "win wins winner winners winning")
SOFT_LIMIT = 2
#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path_end = min((i for i in (rest.find(c, end) for c in "?#") if i >= 0), default=len(rest))
    return rest[:end].translate(_LOWER), rest[end:path_end]


class Rules:
    """The longest rule whose host is the url's or above it, and whose path
    starts the url's.  Rules of equal length: block before allow."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.by_host: dict[str, list[tuple[int, int, str, str, str]]] = {}
        for verdict, host, path in rules:
            rule = f"{host}{path}"
            self.by_host.setdefault(host, []).append((-len(rule), verdict == "allow", path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        fits, at = [], 0
        while True:
            fits += [r for r in self.by_host.get(host[at:], ()) if path.startswith(r[2])]
            dot = host.find(".", at)
            if dot < 0:
                break
            at = dot + 1
        return min(fits)[3:] if fits else None


class Vocabulary:
    """Counts strict and distinct soft terms of a url, delimited on both sides."""

    def __init__(self, strict: Iterable[str], soft: Iterable[str], soft_limit: int):
        self.limit, self.found = soft_limit, ahocorasick.Automaton()
        self.strict = frozenset(t.translate(_LOWER) for t in strict)
        for weight, terms in ((1, soft), (soft_limit, self.strict)):
            for t in terms:
                for form in (t := t.translate(_LOWER)).split():
                    self.found.add_word(form, (t, weight, len(form)))
        if len(self.found):
            self.found.make_automaton()

    def hits(self, url: str) -> dict[str, int]:
        """Term -> weight of the terms found; a strict term weighs the limit."""
        if not len(self.found):
            return {}
        url, out = url.translate(_LOWER), {}
        for end, (term, weight, length) in self.found.iter(url):
            start = end - length
            if (start < 0 or url[start] not in _ALNUM) and (end + 1 == len(url) or url[end + 1] not in _ALNUM):
                out[term] = weight
        return out

    def blocks(self, hits: dict[str, int]) -> bool:
        return sum(hits.values()) >= self.limit


def url_verdicts(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT,
                 soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, strict_hits, soft_hits.

    A rule's verdict stands; without a rule the vocabulary decides.  A null
    url or one without ``://`` has empty host and path; a null url has no
    hits and is allowed.  Repeated rows are judged alike; an empty table gives
    no rows.  Columns but page_id and url are not looked at.
    """
    rules, strict, soft = tuple(rules), tuple(strict), tuple(soft)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, words = Rules(rules), Vocabulary(strict, soft, soft_limit)
        for b in it:
            rows = []
            for url in b.column(1).to_pylist():
                host, path = split_url(url)
                hits = words.hits(url or "")
                n_strict = len(hits.keys() & words.strict)
                own = "block" if words.blocks(hits) else "allow"
                rule, verdict = table.find(host, path) or (None, own)
                rows.append((host, path, rule, verdict, n_strict, len(hits) - n_strict))
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.string()] * 4 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["page_id", "host", "path", "rule", "verdict",
                                                    "strict_hits", "soft_hits"])

    return pages.select("page_id", pages["url"].cast("string")).mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string, "
             "strict_hits int, soft_hits int")


def oracle(rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> str:
    """The same verdicts as DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    forms = lambda t: "|".join(map(re.escape, t.translate(_LOWER).split()))
    has = lambda t: f"regexp_matches(u, '(^|[^a-z0-9])({forms(t)})([^a-z0-9]|$)')::INT"
    rule_rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH cut AS (
  SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS u,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
judged AS (
  SELECT *, ({' + '.join(map(has, strict))}) AS strict_hits, ({' + '.join(map(has, soft))}) AS soft_hits FROM parts),
rules(verdict, h, p) AS (VALUES {rule_rows}),
fits AS (
  SELECT j.page_id, r.h || r.p AS rule, r.verdict,
         row_number() OVER (PARTITION BY j.page_id ORDER BY length(r.h || r.p) DESC, r.verdict = 'allow') AS k
  FROM judged j JOIN rules r
    ON (j.host = r.h OR ends_with(j.host, '.' || r.h)) AND starts_with(j.path, r.p))
SELECT j.page_id, j.host, j.path, f.rule,
       coalesce(f.verdict, CASE WHEN strict_hits > 0 OR soft_hits >= {soft_limit} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_hits::INT AS strict_hits, soft_hits::INT AS soft_hits
FROM judged j LEFT JOIN fits f ON f.page_id = j.page_id AND f.k = 1"""
