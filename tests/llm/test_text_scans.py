"""Quality rules, the line field, secrets and licenses against plain versions."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from tally.llm.automaton import SEPARATOR, Expression, combined, compiled
from tally.llm.licenses import TEMPLATES, Scanner, increasing, license_scan, patience
from tally.llm.line_crf import _Chains, fit, held_out, keep_good, quality_scores, sample_of, training_texts
from tally.llm.quality_rules import quality_rules
from tally.llm.secrets import RULES, redact_secrets, secret_scan, spans_of
from tests.llm.awkward import collected, documents, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marked = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


def test_rules_count_as_defined(spark):
    rng = random.Random(5)
    parts = ["a", "b", "é", " ", "\n", "#", " ", " ", "\x1c", "\xa0", "A|B"]
    rows = [*texts(), *((1000 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(400))]
    got = Counter(
        tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        for r in collected(quality_rules(documents(spark, rows)))
    )
    expected = Counter()
    for i, t in rows:
        b = base(t or "")
        expected[(i, *b, b[0] < 10 or 100 * b[4] > 20 * b[0])] += 1
    assert got == expected


def test_rules_remove_lines_and_reject_what_loses_too_much(spark):
    good, bar = prose(1), "Home | News | Sport | Shop | Help | About"
    menu = "\n".join(" | ".join(prose(n * 10 + k, 1) for k in range(6)) for n in range(60, 66))
    rows = [(1, f"{good}\n{bar}\nAll rights reserved."), (2, f"{prose(2, 12)}\n{menu}"), (3, good)]
    got = {r["doc_id"]: r for r in collected(quality_rules(documents(spark, rows), with_text=True))}
    assert got[1]["kept"] and got[1]["cleaned_text"] == good and got[1]["lines_navigation"] == got[1]["lines_boilerplate"] == 1
    assert not got[2]["kept"] and not got[2]["base_failed"]
    assert got[3]["kept"] and got[3]["lost"] == 0
    assert quality_rules(documents(spark, [])).count() == 0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    sizes = [1, 4, 3, 6]
    first = np.concatenate([[0], np.cumsum(sizes)])
    odds, trans = rng.normal(size=first[-1]), rng.normal(size=(2, 2))
    good, pairs = _Chains(first).marginals(odds, trans)
    expected, expected_pairs = np.zeros(first[-1]), np.zeros((2, 2))
    for a, n in zip(first[:-1], sizes, strict=True):
        labels = np.array(np.meshgrid(*[[0, 1]] * n)).reshape(n, -1).T
        score = np.exp([(odds[a : a + n] * y).sum() + sum(trans[p, q] for p, q in zip(y, y[1:], strict=False)) for y in labels])
        score /= score.sum()
        expected[a : a + n] = score @ labels
        for y, s in zip(labels, score, strict=True):
            for p, q in zip(y, y[1:], strict=False):
                expected_pairs[p, q] += s
    assert np.allclose(good, expected) and np.allclose(pairs, expected_pairs)


def test_field_tells_good_from_bad_lines(spark):
    bar = "Home | News | Sport | Shop | Help | About\n"
    rows = [(i, f"{prose(i)}\n{prose(i + 1000)}" if i % 2 else bar * 4 + prose(i, 6)) for i in range(200)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(0, 1), (500, None)], "doc_id long, quality int")
    samples, good = training_texts(docs, labels.where(~held_out()), per_class=60)
    assert len(samples) <= 120 and set(good) == {0, 1}
    field = fit(samples, good)
    got = collected(quality_scores(docs, field).withColumn("held", held_out()))
    assert all(r["predicted"] == r["doc_id"] % 2 and 0 <= r["score"] <= 1 for r in got if r["held"])
    kept = keep_good(docs, field)
    assert kept.columns == docs.columns and {r["doc_id"] for r in collected(kept)} == {i for i, _ in rows if i % 2}
    odd = collected(quality_scores(documents(spark), field))
    assert len(odd) == len(texts()) and all(0 <= r["score"] <= 1 for r in odd)
    assert keep_good(documents(spark, []), field).count() == 0


def test_training_holds_a_bounded_number_of_lines():
    texts_ = ["a\n" * 10_000 + str(i) for i in range(40)] + [prose(i) + "\n" + prose(i + 500) for i in range(40)]
    sample = sample_of(texts_, 64)
    assert sample.features.shape == (40 * 64 + 40 * 2, 43) and sample.features.dtype == np.float32
    assert np.diff(sample.first).tolist() == [64] * 40 + [2] * 40
    whole = sample_of(texts_[:1])
    begins = [b for b in range(len(whole.features) - 63) if np.array_equal(whole.features[b : b + 64], sample.features[:64])]
    assert begins  # a stretch of the text, its neighbours' features included
    field = fit(sample, np.array([0] * 40 + [1] * 40))
    bad, good = field.scores([texts_[0], texts_[50]])
    assert bad < 0.3 < good


def test_field_without_labels():
    assert fit([], np.empty(0)).scores(["", "x"]).tolist() == [0.5, 0.5]


def spans(text):
    out = []
    for i, r in enumerate(RULES):
        for m in re.compile(r.pattern, (re.I if r.ignore_case else 0) | re.A).finditer(text):
            if len(m[r.group]) >= r.least:
                out.append((m.start(), i, m.end()))
    return sorted(out)


def test_secrets_equal_each_rule_alone():
    rng = random.Random(3)
    parts = ["token", "API_KEY", "apikey", "passwd", "Secret", "password", "=", ":", " ", "  ", '"', "'", "abc", "deadbeef0123", "AKIA"]
    parts += ["ABCD1234EFGH5678", "é", "\n", ",", "ghp_", "a1" * 20, "eyJ", "xoxb-", "bearer ", "AIza", "日", ".", "-----BEGIN RSA PRIVATE KEY-----"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(5000)] + ["a" * 50_000, "token=" + "b" * 50_000]
    found = spans_of(rows)
    assert [found.get(i, []) for i in range(len(rows))] == [spans(t) for t in rows]


def test_secret_query(spark):
    got = collected(secret_scan(documents(spark)))
    expected = Counter()
    for i, t in texts():
        s = spans(t or "")
        listed = [(RULES[k].kind, f"{RULES[k].kind}:{a}:{b}") for a, k, b in s]
        own = [x for kind, x in listed if kind in ("assign", "access", "hex")]
        counts = [sum(kind == k for kind, _ in listed) for k in ("assign", "access", "hex")]
        expected[(i, *counts, hashlib.sha256(",".join(own).encode()).hexdigest(), ",".join(x for _, x in listed))] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")) for r in got) == expected
    assert secret_scan(documents(spark, [])).count() == 0


def test_secrets_are_masked(spark):
    docs = documents(spark)
    masked = {r["doc_id"]: r for r in collected(redact_secrets(docs))}
    assert masked[12]["text"] == "[secret]' [secret]\né [secret]"
    assert masked[5]["text"] is None and masked[11]["text"] == dict(texts())[11]
    assert redact_secrets(docs).columns == docs.columns


def test_automaton_reads_classes_counts_and_choices():
    made = compiled([(r"a[b-d]{2,3}e?", False), (r"(x|yz)+!", True), (r"[^a]q", False)])
    for text in ("abce", "zabbde", "xYZx!", "aq bq", "abb", ""):
        states = made.states(np.frombuffer(text.encode() + bytes([SEPARATOR]), np.uint8))
        hits = made.accepts[states]
        for i, pattern in enumerate((r"a[b-d]{2,3}e?", r"(?i:(x|yz)+!)", r"[^a]q")):
            ends = {e for e in range(len(text) + 1) for s in range(e) if re.fullmatch(pattern, text[s:e])}
            assert {p + 1 for p in np.flatnonzero(hits >> i & 1).tolist()} == ends
    with pytest.raises(ValueError):
        compiled([(r"a(?=b)", False)])


def test_base_rules_are_those_of_the_contract():
    """A count in the pattern spares hits in every word of a to f and changes no span."""
    base = (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+")
    rng = random.Random(5)
    parts = ["0a" * 11, "f", "9", "g", "token=", "secret", "AKIA", "Z" * 15, "Q", " ", '"', "=", ".", "abc"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    found = spans_of(rows)
    for i, text in enumerate(rows):
        plain = [(m.start(), k, m.end()) for k, (p, least) in enumerate(zip(base, (6, 20, 24), strict=True)) for m in re.finditer(p, text) if len(m[2 if k == 0 else 0]) >= least]
        assert [s for s in found.get(i, []) if s[1] < 3] == sorted(plain)


def test_secrets_in_long_texts_take_linear_time():
    for part in ("AIza ", "eyJ ", "-----BEGIN ", "-----BEGIN \n", "eyJa.b.", "token=a ", "eyJ", "AKIA", "0f", "token=", "xoxb-ghp_bearer "):
        text = part * (1_000_000 // len(part))
        begun = time.perf_counter()
        found = spans_of([text]).get(0, [])
        assert time.perf_counter() - begun < 10
        if part in ("AIza ", "eyJ ", "-----BEGIN ", "-----BEGIN \n"):
            assert found == []
    assert spans_of(["0f" * 500_000])[0] == [(0, 2, 1_000_000)]


def test_expressions_find_what_a_longest_match_search_finds():
    rng = random.Random(7)
    for pattern, group in ((r"ab+c?", 0), (r"(a|ab)(c+)", 2), (r"a+(ab*)", 1), (r"[ab]{2,4}c", 0), (r"(ab|b)+c", 0)):
        made = Expression(pattern, group=group)
        for _ in range(400):
            text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
            expected, at = [], 0
            while at < len(text):
                ends = [e for e in range(at + 1, len(text) + 1) if re.fullmatch(pattern, text[at:e])]
                if ends:
                    expected.append((at, ends[-1]))
                at = ends[-1] if ends else at + 1
            got = list(made.matches(text.encode(), 0, len(text)))
            assert [(s, e) for s, _, e in got] == expected
            assert all(s <= g < e for s, g, e in got)
    for bad, group in ((r"a*", 0), (r"(a)b", 1)):
        with pytest.raises(ValueError):
            Expression(bad, group=group)


def test_combined_automaton_accepts_what_each_accepts():
    patterns = (r"a[b-d]{2,3}e?", r"(x|yz)+!", r"[^a]q", r"cd")
    single = [compiled([(p, False)]) for p in patterns]
    both = combined(single)
    rng = random.Random(9)
    text = "".join(rng.choice("abcdexyz!q\n") for _ in range(20_000)).encode() + bytes([SEPARATOR])
    buffer = np.frombuffer(text, np.uint8)
    states = both.states(buffer)
    own = [m.states(buffer) for m in single]
    for i, m in enumerate(single):
        assert ((both.accepts[states] >> i & 1) == (m.accepts[own[i]] != 0)).all()
    assert ((states == 0) == np.all([o == 0 for o in own], axis=0)).all()


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_patience_alignment():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.randint(0, 12) for _ in range(rng.randint(0, 14))] for _ in range(2))
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < u and y < v for (x, y), (u, v) in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= longest(a, b)
    words = list(range(30))
    assert len(patience(words, words)) == 30
    assert len(patience(words[:10] + [99] + words[10:], words)) == 30
    assert [[5, 1, 4, 2, 3][i] for i in increasing([5, 1, 4, 2, 3])] == [1, 2, 3]


def test_licenses(spark):
    got = {r["doc_id"]: r for r in collected(license_scan(documents(spark)))}
    assert [x.split(":")[0] for x in got[14]["licenses"].split(",")] == ["all-rights-reserved", "mit-notice"]
    assert got[14]["kinds"] == "permissive,reserved" and got[14]["best_coverage"] == 1
    assert all(r["n_licenses"] == 0 and r["best_license"] is None for i, r in got.items() if i != 14)
    assert license_scan(documents(spark, [])).count() == 0


def test_every_template_is_found_in_changed_and_long_texts():
    scanner = Scanner()
    for t in TEMPLATES:
        words = t.text.split()
        if len(words) > 20:
            words[len(words) // 2 :: 11] = ["changed"] * len(words[len(words) // 2 :: 11])
        text = f"{prose(1, 500)} {' '.join(words).upper()} {prose(2, 500)} {t.text}"
        found = scanner.scan([text])[0]
        assert [f[2] for f in found if f[2] == t.name].__len__() in (1, 2) and found[-1][2] == t.name, t.name
