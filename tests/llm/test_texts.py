"""Row-wise operators against plain brute-force versions."""

import base64
import collections
import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_TEXTS, SF_SMALL
from tests.support import plan
from tidemark.llm import bpe, pii, quality_rules
from tidemark.llm.queries import QUERIES, RANKS, token_digests

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {
        j
        for i, g in enumerate(zip(words, words[1:], words[2:]))
        if grams[g] > 1
        for j in (i, i + 1, i + 2)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(hit),
    )


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_measures_of_odd_texts(text):
    assert quality_rules.measure(text)[:5] == plain_measures(text)


def test_quality_rules(spark, texts):
    rows = QUERIES["op3_quality_rules"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain_measures(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_rules_adapt_to_their_group(spark):
    """Twenty symbols a word are normal in one source and far outside another."""
    words = [f"w{i}" for i in range(60)]
    noisy, clean = " ".join(w + "#" * 20 for w in words), " ".join(words)
    rows = [(i, noisy, "en", "code") for i in range(300)]
    rows += [(1000 + i, clean, "en", "prose") for i in range(300)]
    rows += [(5000, noisy, "en", "prose"), (5001, clean, "en", "tiny"), (5002, noisy, "en", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert all(kept[i] for i in range(300)) and all(kept[1000 + i] for i in range(300))
    assert not kept[5000] and kept[5001]


def test_sketches_merge_to_the_same_sketch(spark, documents):
    rows = quality_rules.measured(
        documents.select(
            "doc_id", quality_rules.group_key("lang").alias("lang_key"),
            quality_rules.group_key("source").alias("source_key"), "text",
        ),
        keep=("lang_key", "source_key"),
    )
    parts = [quality_rules.sketches(rows.filter(f"n_words % 2 = {k}")) for k in (0, 1)]
    keys = ["lang_key", "source_key"]
    both = quality_rules.merged(parts[0].unionByName(parts[1]), keys)
    whole = quality_rules.merged(quality_rules.sketches(rows), keys)
    assert both.exceptAll(whole).count() == whole.exceptAll(both).count() == 0


@pytest.fixture(scope="module")
def reference_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.rank_file(RANKS), public_tokenizers.PATTERN)


def test_bpe_query(spark, texts, reference_encoding):
    rows = QUERIES["op4_byte_bpe"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = reference_encoding.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(text=st.text() | st.text(alphabet="abthe \n'sd1é🎉", max_size=400))
def test_bpe_any_text(text, encoder, reference_encoding):
    lists = encoder.encode([text])
    ids = lists.to_pylist()[0]
    assert ids == reference_encoding.encode_ordinary(text)
    assert bpe.decode_lists(encoder.vocabulary, lists).to_pylist() == [text.encode()]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_bpe_odd_texts(text, encoder, reference_encoding):
    assert encoder.encode([text]).to_pylist()[0] == reference_encoding.encode_ordinary(text or "")


def test_bpe_long_and_short_ways_agree(encoder):
    pieces = [("the" * n + "qu" * n).encode()[: 3 * n] for n in range(1, 60)]
    rows = bpe.merge_matrix(encoder.vocabulary, pieces)
    assert rows == [bpe.merge_long(encoder.vocabulary.ranks, p) for p in pieces]


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn_sum(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn_sum(digits) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), list(PLAIN).index(kind), kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def base(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.spans_of(text) if s["kind"] in PLAIN]


def test_pii_query(spark, texts):
    for r in QUERIES["op7_pii"](spark, SF_SMALL).collect():
        want = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in PLAIN]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+1 2549(0)é🎉", max_size=80))
def test_pii_any_text(text):
    assert base(text) == plain_spans(text)


def test_pii_checksums_and_context():
    found = lambda t: [(s["kind"], t[s["start"] : s["end"]]) for s in pii.spans_of(t)]
    assert ("iban", "DE89370400440532013000") in found("pay to DE89370400440532013000 now")
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in found("GB82 WEST 1234 5698 7654 32")
    assert not found("pay to DE89370400440532013001 now")
    assert found("SSN 123-45-6789") == [("ssn", "123-45-6789")]
    assert not found("part 123-45-6789") and not found("ssn 666-45-6789")
    assert found("born on 1980-02-03") == [("birth_date", "1980-02-03")]
    assert not found("on 1980-02-03")


def test_pii_is_linear():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000):
        pii.spans_of(text)


@pytest.mark.parametrize("find", [quality_rules.judge, pii.find], ids=["rules", "pii"])
def test_odd_tables(odd, find):
    rows = find(odd).collect()
    assert len(rows) == odd.count() and sum(r.doc_id is None for r in rows) == 1
    assert find(odd.limit(0)).count() == 0


def test_bpe_passes_a_text_through_python_once(odd):
    """Two passes in a row keep two Python workers with a vocabulary each for every task."""
    ranks = bpe.rank_file(RANKS)
    found = bpe.round_trip(odd, ranks, public_tokenizers.PATTERN)
    assert plan(token_digests(odd)).count("MapInArrow") == plan(found).count("MapInArrow") == 1
    want = bpe.decode(bpe.encode(odd, ranks, public_tokenizers.PATTERN), ranks)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.select(*found.columns).collect()))


def test_bpe_odd_table(odd):
    ranks = bpe.rank_file(RANKS)
    run = lambda d: bpe.decode(bpe.encode(d, ranks, public_tokenizers.PATTERN), ranks)
    rows = run(odd).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted(
        (r.text or "").encode() for r in odd.select("text").collect()
    )
    assert run(odd.limit(0)).count() == 0
