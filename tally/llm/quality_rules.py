"""Line-first cleaning: each line is held against rules, failing lines go, documents that lose too much text go."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.batches import balanced, byte_slices, texts_of
from tally.llm.lines import Lines
from tally.llm.words import Words

# phrases of pages rather than of prose; they count in lines of at most ``boilerplate_words`` words
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies", "use cookies",
    "sign in", "sign up", "log in", "subscribe to", "unsubscribe", "click here", "read more", "share this", "follow us", "back to top",
    "skip to content", "add to cart", "enable javascript", "lorem ipsum", "powered by", "leave a comment", "newsletter",
)


@dataclass(frozen=True)
class LineRules:
    """Shares above which a line fails, and how much of its text a document may lose."""

    symbols_per_word: float = 0.25  # characters of [#*$%&|<>]
    bangs_per_word: float = 0.3  # exclamation and question marks
    shouting: float = 0.7  # capitals among letters, in lines of shout_words words or more
    shout_words: int = 4
    separators: float = 0.15  # words that are a bar, angle or middle dot
    stutter: float = 0.3  # words equal to the word before
    repeated: float = 0.5  # words in runs of five that the text holds twice
    digits: float = 0.5  # digits among letters and digits
    boilerplate_words: int = 20
    most_lost: float = 0.5  # share of the text's characters in words


def failing(lines: Lines, texts: list[str], rules: LineRules) -> dict[str, np.ndarray]:
    """By rule family, which lines fail. Lines without a word fail nothing."""
    words = np.maximum(lines.n_words, 1)
    letters = np.maximum(lines.letters, 1)
    punctuation = (
        (lines.symbols > rules.symbols_per_word * words)
        | (lines.bangs > np.maximum(rules.bangs_per_word * words, 1))
        | ((lines.upper > rules.shouting * letters) & (lines.n_words >= rules.shout_words))
        | (lines.digits > rules.digits * (lines.letters + lines.digits))
    )
    navigation = lines.bars > rules.separators * words
    boilerplate = (
        (lines.stutters > np.maximum(rules.stutter * words, 1))
        | (lines.count_words(lines.repeated) > rules.repeated * words)
        | lines.seen_before
    )
    short = lines.n_words <= rules.boilerplate_words
    for i, text in enumerate(texts):
        low = text.lower()
        for phrase in BOILERPLATE:
            at = low.find(phrase)
            while at >= 0:
                line = lines.first[i] + low.count("\n", 0, at)
                boilerplate[line] |= short[line]
                at = low.find(phrase, at + 1)
    there = lines.n_words > 0
    return {"punctuation": punctuation & there, "navigation": navigation & there, "boilerplate": boilerplate & there}


def quality_rules(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: LineRules = LineRules(), with_text: bool = False
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    lines_punctuation, lines_navigation, lines_boilerplate (lines that fail), lost (share of word characters in them),
    and with ``with_text`` cleaned_text (the lines that pass).

    A document is kept if it passes the base rules (10 words or more, at most a fifth of them in repeated runs of five)
    and loses no more than ``rules.most_lost`` of its characters in words. Null and empty texts have no words and fail;
    repeated rows are judged each; an empty table gives an empty one; further columns are left behind. Texts are read
    whole, a few MB at a time. No shuffle.
    """
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines_punctuation", "lines_navigation", "lines_boilerplate"]

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches):
            texts = texts_of(part)
            words = Words.of(texts)
            lines = Lines(words)
            chars = lines.count(((words.buffer & 0xC0) != 0x80) & ~words.space)
            fails = failing(lines, texts, rules)
            bad = np.logical_or.reduce(list(fails.values()))
            n_words, n_chars = words.counts, lines.per_text(chars)
            n_repeat = lines.per_text(lines.count_words(lines.repeated))
            base_failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)
            lost = lines.per_text(np.where(bad, chars, 0)) / np.maximum(n_chars, 1)
            columns = [
                part.column("id"),
                *(
                    pa.array(c, pa.int64())
                    for c in (n_words, n_chars, lines.per_text(lines.symbols), lines.per_text(lines.seen_before), n_repeat, *(lines.per_text(f) for f in fails.values()))
                ),
                pa.array(lost),
                pa.array(base_failed),
                pa.array(~base_failed & (lost <= rules.most_lost)),
            ]
            if with_text:
                columns.append(
                    pa.array(["\n".join(x for x, b in zip(t.split("\n"), bad[a:z].tolist(), strict=True) if not b) for t, a, z in zip(texts, lines.first, lines.first[1:], strict=False)], pa.string())
                )
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    narrow = balanced(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    schema = T.StructType(
        [
            narrow.schema["id"],
            *(T.StructField(c, T.LongType()) for c in longs),
            T.StructField("lost", T.DoubleType()),
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("kept", T.BooleanType()),
            *([T.StructField("cleaned_text", T.StringType())] if with_text else []),
        ]
    )
    return narrow.mapInArrow(judge, schema).withColumnRenamed("id", id_column)
