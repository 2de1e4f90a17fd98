import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweave.functions import text
from logweave.functions.times import nano_text, order_keys, parse_instant, stable_request_id
from logweave.operators import filters

EDGE = re.compile(r"[0-9A-Za-z_]")


def plain_mask(value: str, words) -> str:
    """Whole-word masking written out: an edge is a change of ASCII word-ness."""

    def edge(t, i):
        before = i > 0 and bool(EDGE.match(t[i - 1]))
        after = i < len(t) and bool(EDGE.match(t[i]))
        return before != after

    def same(a, b):
        fold = str.maketrans(text.FOLD_FROM, text.FOLD_TO)
        return a.lower().translate(fold) == b.lower().translate(fold)

    for word in words:
        word = word.strip().lower()
        if not word:
            continue
        i, out = 0, ""
        while i < len(value):
            j = i + len(word)
            if j <= len(value) and same(value[i:j], word) and edge(value, i) and edge(value, j):
                out += "*" * len(word)
                i = j
            else:
                out += value[i]
                i += 1
        # Edges are those of the text before this word, so masking builds a new text.
        value = out
    return value


CASES = [
    ("Spam is bad, but spamming is a different word", ["bad", "spam"], "**** is ***, but spamming is a different word"),
    ("c b a", ["b a", "c b"], "c ***"),
    ("это спам тут", ["спам"], "это спам тут"),
    ("xспамy", ["спам"], "x****y"),
    ("déde", ["de"], "dé**"),
    ("a.b axb", ["a.b"], "*** axb"),
    (r"use \Q and \E now", [r"q and \e"], r"use \******** now"),
    ("cost $5 or x$$y", ["$$"], "cost $5 or x**y"),
    ("Spam", ["", "  "], "Spam"),
    ("THE the The", ["the"], "*** *** ***"),
    ("\u212aey xſ", ["key", "xs"], "\u212aey xſ"),
    ("x\u212aey", ["key"], "x***"),
    ("ICI \u0130ci ici", ["ici"], "*** \u0130ci ***"),
    ("ÉTÉ xÉTÉy", ["été"], "ÉTÉ x***y"),
    ("a\nb", ["a\nb"], "***"),
]


@pytest.mark.parametrize("value,words,wanted", CASES)
def test_mask_cases(one, value, words, wanted):
    assert plain_mask(value, words) == wanted
    assert one(text.mask_with("t", words), t=value) == wanted
    assert one(text.mask_each("t", "w"), t=value, w=words) == wanted


def test_mask_unicode_boundary(one):
    assert one(text.mask_with("t", ["спам"], boundary="unicode"), t="это спам тут") == "это **** тут"


ALPHABET = "abC1_ é$*-ſKks"


def test_mask_by_lookup_equals_fold(spark):
    """Long lists go through the run join; the result is that of the plain fold."""
    import random

    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    words = sorted(
        {"".join(rng.choice("abc1_ é$*-ks") for _ in range(rng.randint(1, 3))).strip() for _ in range(60)}
        - {""},
        key=str.encode,
    )
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")
    masked = filters.mask_snapshot(rows, vocabulary, "id", "text", chain_words=0, listed_words=0)
    listed = filters.mask_snapshot(rows, vocabulary, "id", "text", chain_words=0)
    chained = filters.mask_snapshot(rows, vocabulary, "id", "text", chain_words=100)
    wanted = {i: plain_mask(t, words) for i, t in enumerate(texts)}
    assert {r["id"]: r["text"] for r in masked.collect()} == wanted
    assert {r["id"]: r["text"] for r in listed.collect()} == wanted
    assert {r["id"]: r["text"] for r in chained.collect()} == wanted


def test_lists(one):
    add = one(text.add_items("a", "b"), a=["alice"], b=["bob", "alice", ""])
    assert add == ["alice", "bob"]
    assert one(text.remove_items("a", "b"), a=add, b=["alice"]) == ["bob"]
    assert one(text.remove_items("a", "b"), a=["b", "b", "a"], b=[" a "]) == ["b", "b"]
    assert one(text.csv_items("v"), v=" host-0:9092, ,host-1:9092 ") == ["host-0:9092", "host-1:9092"]
    assert one(text.contains_item("a", F.lit("x")), a=["x"]) is True


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet="\t\n  　 ab", max_size=8))
def test_trim(one, value):
    assert one(text.trimmed("v"), v=value) == value.strip()


def test_instants(one):
    early = one(parse_instant("v"), v="2026-05-15T00:00:00Z")
    later = one(parse_instant("v"), v="2026-05-15T00:00:00.5Z")
    assert early < later
    assert one(parse_instant("v"), v="2026-05-15T02:00:00.123456789+02:00") == one(
        parse_instant("v"), v="2026-05-15T00:00:00.123456Z"
    )
    assert one(parse_instant("v"), v="2026-05-15") is None
    assert one(parse_instant("v"), v="2026-13-15T00:00:00Z") is None
    assert one(nano_text(parse_instant("v")), v="2026-05-15T00:00:00.500Z") == "2026-05-15T00:00:00.5Z"
    assert one(nano_text(parse_instant("v")), v="2026-05-15T00:00:00Z") == "2026-05-15T00:00:00Z"


def test_ids(one):
    assert one(order_keys("a", "b"), a="u", b="p") == "u:p"
    first = one(stable_request_id("a", "b"), a="u", b="p")
    assert len(first) == 32 and first == one(stable_request_id("a", "b"), a="u", b="p")


@pytest.mark.parametrize("count", [8, 9, 60])
def test_unicode_edges_give_one_result_for_any_length_of_list(spark, count):
    rng = random.Random(count)
    letters = "aséßσςİıKжЖ日_1"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 3))).lower() for _ in range(count)}
    words |= {"é", "$$", "x é"}
    tokens = [*words, *(w.upper() for w in words), "é1", "$$", "***", "Σ", "x"]
    texts = [(i, "".join(rng.choice(tokens) + rng.choice([" ", "$$", "", "'"]) for _ in range(6))) for i in range(80)]
    messages = spark.createDataFrame(texts, "message_id int, text string")
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    cleaned = sorted({w.strip().lower() for w in words} - {""}, key=str.encode)
    wanted = dict(messages.select("message_id", text.mask_with("text", cleaned, "unicode")).collect())
    for chain, most in ((0, 1000), (0, 0)):
        found = filters.mask_snapshot(messages, listed, boundary="unicode", chain_words=chain, listed_words=most)
        assert {r["message_id"]: r["text"] for r in found.collect()} == wanted
