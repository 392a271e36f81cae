"""Secret scans by one combined automaton over the bytes of whole texts.

The rules' own expressions are compiled, as a whole, into one automaton, and one pass over the bytes tells where matches
of any of them end. Only the stretches around such ends are read again: back, by the automaton of the reversed rule, for
the places where matches begin, and from those on for the end of the longest. Both passes are linear in the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.automaton import SEPARATOR, Automaton, Expression, combined
from tally.llm.batches import balanced, byte_slices, texts_of


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost, longest and not overlapping, whose ``group`` has ``least`` characters or more.

    A match that is too short counts for nothing, but the next one begins behind it. ``group`` must be the last part of
    the pattern (0: the whole). Letters match in either case with ``ignore_case``.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    ignore_case: bool = False


# fixed values: the kinds that every scan reports
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        ignore_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
# fixed values: public formats of keys that name themselves
NAMED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", least=24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"bearer\x20+([A-Za-z0-9._~+/-]+=*)", least=16, group=1, ignore_case=True),
)
RULES = BASE + NAMED

Spans = list[tuple[int, int, int]]  # (start, number of the rule, end), in code points


@lru_cache(maxsize=4)
def _built(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Expression]]:
    each = [Expression(r.pattern, r.ignore_case, r.group) for r in rules]
    return combined([e.ends for e in each]), each


def spans_of(texts: list[str], rules: tuple[Rule, ...] = RULES) -> dict[int, Spans]:
    """The spans of the texts that have any, by the text's place, in order of start and rule.

    One pass over all bytes gives the states; where one accepts, matches of the rules that its bits name end. A match
    begins behind the last place where the state was the start, and no rule reads on behind the next such place, so the
    stretch between them is all that these rules' own automata read.
    """
    automaton, each = _built(rules)
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = bytes([SEPARATOR]).join([*raw, b""])
    buffer = np.frombuffer(data, np.uint8)
    states = automaton.states(buffer)
    hits = np.flatnonzero(automaton.accepts[states])
    if not len(hits):
        return {}
    quiet = np.flatnonzero(states == 0)
    after = np.searchsorted(quiet, hits)
    stretches, heads = np.unique(after, return_index=True)
    bits = np.bitwise_or.reduceat(automaton.accepts[states[hits]], heads).tolist()
    points = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
    found: dict[int, Spans] = {}
    for stretch, on in zip(stretches.tolist(), bits, strict=True):
        begin = int(quiet[stretch - 1]) + 1 if stretch else 0
        until = int(quiet[stretch])
        text = int(np.searchsorted(ends, begin, side="right"))
        zero = points[ends[text] - 1 - len(raw[text])]
        for i, rule in enumerate(rules):
            if on >> i & 1:
                for start, group, end in each[i].matches(data, begin, until):
                    if points[end] - points[group] >= rule.least:
                        found.setdefault(text, []).append((int(points[start] - zero), i, int(points[end] - zero)))
    return {text: sorted(spans) for text, spans in found.items()}


def secret_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` lists all spans as kind:start:end (code points, end exclusive) by start, then by the rule's place in
    ``rules``; ``base_sha256`` is the lowercase hex digest of such a list of the three base kinds alone (of the empty
    string if there is none). Null and empty texts have no spans; repeated rows are scanned each; an empty table gives
    an empty one; further columns are left behind. Very long texts are scanned whole. No shuffle.
    """
    base = {i: r.kind for i, r in enumerate(rules) if r.kind in ("assign", "access", "hex")}

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches):
            found = spans_of(texts_of(part), rules)
            rows = [found.get(i, []) for i in range(part.num_rows)]
            counts = [[sum(base.get(i) == kind for _, i, _ in spans) for spans in rows] for kind in ("assign", "access", "hex")]
            listed = [[f"{rules[i].kind}:{a}:{b}" for a, i, b in spans] for spans in rows]
            digest = [hashlib.sha256(",".join(x for x, s in zip(texts, spans, strict=True) if s[1] in base).encode()).hexdigest() for texts, spans in zip(listed, rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array([",".join(x) for x in listed], pa.string())],
                ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    narrow = balanced(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    schema = T.StructType(
        [
            narrow.schema["id"],
            *(T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")),
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )
    return narrow.mapInArrow(scan, schema).withColumnRenamed("id", id_column)


def redacted(text: str, spans: Spans, mask: str) -> str:
    """The text with each run of overlapping spans replaced by the mask."""
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact_secrets(docs: DataFrame, text_column: str = "text", mask: str = "[secret]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``docs``, with every secret in the text replaced by ``mask``; null texts stay null."""
    at = docs.columns.index(text_column)
    names = [f"c{i}" for i in range(len(docs.columns))]

    def redact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, names[at]):
            found = spans_of(texts_of(part, names[at]), rules)
            if found:
                texts = part.column(at).to_pylist()
                for i, spans in found.items():
                    texts[i] = redacted(texts[i], spans, mask)
                part = part.set_column(at, names[at], pa.array(texts, part.schema.field(at).type))
            yield part

    numbered = balanced(docs.toDF(*names))  # whatever the columns are called
    return numbered.mapInArrow(redact, numbered.schema).toDF(*docs.columns)
