"""URL filters: host and path rules, then a weighted vocabulary that an Aho-Corasick automaton counts.

A url's words are read from its host and path. All urls of a batch form one buffer, and the automaton finds every term
in one pass over it; a hit counts only between boundaries, so "bet" isn't found in "alphabet". A strict term weighs the
whole limit and rejects alone; soft terms weigh less, count once each, and reject when several reach the limit together.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 10

# --- fixed values: terms by weight; the limit alone is strict, less is soft ---
STRICT = (
    "porn", "porno", "pornos", "xxx", "hentai", "milf", "camgirls", "sexcam", "sexcams", "sextube", "escort girls",
    "casino", "casinos", "slot machine", "spielautomaten", "tragamonedas", "sportsbook", "free spins", "no deposit bonus",
    "viagra", "cialis", "levitra", "tramadol", "phentermine", "xanax online", "penis enlargement",
    "payday loan", "payday loans", "replica watches", "essay mill", "link farm", "spam farm", "doorway pages",
    "keygen", "keygens", "warez", "nulled", "crackz", "serialz",
)
SOFT = {
    7: ("bets", "betting", "gambling", "jackpot", "poker", "roulette", "wetten", "apuestas", "paris sportifs", "malware", "phishing"),
    6: ("pills", "pharmacy", "pharmacie", "apotheke", "farmacia", "drugs", "adult", "sexy", "erotic", "erotik", "nude", "torrent", "crack", "spam", "replica"),
    5: ("ads", "adserver", "adclick", "popunder", "popup", "track", "tracker", "tracking", "affiliate", "clickbait", "doubleclick", "banner", "slots", "lottery", "bingo", "escort", "dating", "webcam", "loan", "loans", "credit"),
    4: ("cheap", "discount", "bonus", "billig", "barato", "pas cher", "coupon", "click", "farm", "proxy", "hack", "serial"),
    3: ("free", "gratis", "gratuit", "kostenlos", "win", "winner", "sale", "buy", "online", "hot", "live", "cash", "money"),
}


class Rule(NamedTuple):
    """Fits ``host`` and all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)

_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_ESCAPED_LETTER, _ESCAPED = re.compile("%[89a-f][0-9a-f]"), re.compile("%[0-7][0-9a-f]")
_WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


def url_words(text: str) -> str:
    """The words of a url, one space apart.

    Digits, letters and everything beyond ASCII form words, all else is a boundary. An escaped byte (``%20``) is a
    boundary too, unless it belongs to a character beyond ASCII.
    """
    low = text.translate(_ASCII_LOWER)
    if "%" in low:
        low = _ESCAPED.sub(" ", _ESCAPED_LETTER.sub("\x80", low))
    return " ".join(_WORD.findall(low))


@dataclass(frozen=True)
class Vocabulary:
    """Weights of terms (words one space apart); ``limit`` rejects, and a term that weighs as much is strict."""

    weights: Mapping[str, int]
    limit: int = LIMIT
    terms: list[str] = field(init=False)

    def __post_init__(self):
        wrong = [t for t in self.weights if not t or url_words(t) != t]
        if wrong:
            raise ValueError(f"terms must be lower-case words one space apart: {wrong}")
        object.__setattr__(self, "terms", list(self.weights))

    def __getstate__(self):  # the automaton is built anew in each worker
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton()
        for i, term in enumerate(self.terms):
            built.add_word(term, (i, len(term)))
        built.make_automaton()
        return built

    def hits(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, term number) of every term that a text (see ``url_words``) holds, each once."""
        if not self.terms:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        buffer = "\n" + "\n".join(texts) + "\n"
        found = [(end, i) for end, (i, size) in self.automaton.iter(buffer) if buffer[end + 1] in " \n" and buffer[end - size] in " \n"]
        ends, terms = np.array(found, np.int64).reshape(-1, 2).T
        line_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        pairs = np.unique(np.searchsorted(line_ends, ends) * len(self.terms) + terms)
        return pairs // len(self.terms), pairs % len(self.terms)

    def counts(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct strict terms, distinct soft terms and the weight of all, for each text."""
        at, term = self.hits(texts)
        weight = np.array([self.weights[t] for t in self.terms], np.int64)[term]
        strict = weight >= self.limit
        n = len(texts)
        return np.bincount(at[strict], minlength=n), np.bincount(at[~strict], minlength=n), np.bincount(at, weight, n).astype(np.int64)


VOCABULARY = Vocabulary(dict.fromkeys(STRICT, LIMIT) | {t: w for w, terms in SOFT.items() for t in terms})


class RuleBook:
    """Rules by host; the longest name that fits wins, the longer host among equals."""

    def __init__(self, rules: Iterable[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for rule in rules:
            self.by_host.setdefault(rule.host, []).append(rule)
        self.depths = sorted({h.count(".") + 1 for h in self.by_host})

    def fitting(self, host: str, path: str) -> Rule | None:
        best = None
        if self.depths:
            labels = host.rsplit(".", self.depths[-1])
            for depth in self.depths:
                if depth > len(labels):
                    break
                for rule in self.by_host.get(".".join(labels[-depth:]), ()):
                    if path.startswith(rule.path) and (best is None or len(rule.name) >= len(best.name)):
                        best = rule
        return best


def url_parts(url: str) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and what the vocabulary reads: both, or all up to ``?`` or ``#`` without ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    raw_host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw_host) + 1, F.length(rest)), "^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    scanned = F.when(at > 0, F.concat(raw_host, path)).otherwise(F.regexp_extract(text, "^[^?#]*", 0))
    return F.translate(raw_host, upper, lower), path, scanned


def url_filter(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    vocabulary: Vocabulary = VOCABULARY,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """The id, host, path, rule, verdict (allow or block), n_strict, n_soft, weight of every row.

    The rule that fits decides (null where none does), else the vocabulary: block where the distinct terms of the url
    weigh ``vocabulary.limit`` or more. n_strict and n_soft count distinct terms and are given beside a rule as well.
    A null url counts as empty: no host, no path, allow. A url without ``://`` has neither host nor path, so no rule
    fits it, but its words are read. Each row is judged alone, so repeated rows, null ids and ties need no care; long
    urls cost in proportion to their length; an empty table gives an empty one; further columns are not read. Rules and
    vocabulary travel with the task: thousands of each are meant, not a table of hosts.
    """
    host, path, scanned = url_parts(url_column)
    parts = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"), scanned.alias("scanned"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = RuleBook(rules)
        for batch in batches:
            hosts, paths, texts = (batch.column(c).to_pylist() for c in ("host", "path", "scanned"))
            strict, soft, weight = vocabulary.counts([url_words(t) for t in texts])
            fits = [book.fitting(h, p) for h, p in zip(hosts, paths, strict=True)]
            verdicts = [r.verdict if r else "block" if w >= vocabulary.limit else "allow" for r, w in zip(fits, weight.tolist(), strict=True)]
            columns = [
                batch.column("id"), batch.column("host"), batch.column("path"), pa.array([r.name if r else None for r in fits], pa.string()),
                pa.array(verdicts, pa.string()), pa.array(strict, pa.int64()), pa.array(soft, pa.int64()), pa.array(weight, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "weight"])

    kind = parts.schema["id"].dataType.simpleString()
    judged = parts.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string, n_strict long, n_soft long, weight long")
    return judged.withColumnRenamed("id", id_column)


def url_filter_sql(rules: Sequence[Rule] = RULES, vocabulary: Vocabulary = VOCABULARY) -> str:
    """The same over the table ``pages`` as DuckDB SQL."""
    terms = ", ".join(f"('{t}', {w})" for t, w in vocabulary.weights.items())
    ruled = ", ".join(f"('{r.name}', '{r.host}', '{r.path}', '{r.verdict}')" for r in rules)
    return f"""
        WITH vocabulary(term, weight) AS (VALUES {terms}),
        rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES {ruled}),
        located AS (SELECT row_number() OVER () AS n, page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages),
        rest AS (SELECT *, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM located),
        hosted AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
        parts AS (
            SELECT n, page_id, mark, url, raw, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM hosted
        ),
        lowered AS (
            SELECT *, translate(CASE WHEN mark > 0 THEN raw || path ELSE regexp_extract(url, '^[^?#]*') END,
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
            FROM parts
        ),
        worded AS (
            SELECT *, ' ' || array_to_string(regexp_extract_all(
                regexp_replace(regexp_replace(low, '%[89a-f][0-9a-f]', chr(128), 'g'), '%[0-7][0-9a-f]', ' ', 'g'),
                '[0-9a-z\\x{{80}}-\\x{{10ffff}}]+'), ' ') || ' ' AS words
            FROM lowered
        ),
        counted AS (
            SELECT n, count_if(weight >= {vocabulary.limit}) AS n_strict, count_if(weight < {vocabulary.limit}) AS n_soft, sum(weight)::BIGINT AS weight
            FROM worded JOIN vocabulary ON contains(words, ' ' || term || ' ') GROUP BY n
        ),
        fitting AS (
            SELECT n, arg_max(rule, (length(rule), length(rule_host))) AS rule, arg_max(rule_verdict, (length(rule), length(rule_host))) AS rule_verdict
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n
        )
        SELECT page_id, host, path, rule,
               coalesce(rule_verdict, CASE WHEN coalesce(weight, 0) >= {vocabulary.limit} THEN 'block' ELSE 'allow' END) AS verdict,
               coalesce(n_strict, 0)::BIGINT AS n_strict, coalesce(n_soft, 0)::BIGINT AS n_soft, coalesce(weight, 0)::BIGINT AS weight
        FROM parts LEFT JOIN counted USING (n) LEFT JOIN fitting USING (n)
    """
