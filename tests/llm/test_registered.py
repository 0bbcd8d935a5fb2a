"""The registered queries that SQL cannot express, over whole tables, against versions of their own."""

import hashlib
import zlib
from collections import Counter

import compare
import pytest
from test_row_operators import edit_distance_within, plain_pii, plain_secrets, plain_verdicts

from kerbside.llm import bpe, decontaminate, secret_scan, token_counts
from kerbside.llm.queries import QUERIES


@pytest.fixture(scope="module")
def texts(folder):
    return {i: t or "" for i, t in compare.duck(folder).execute("SELECT doc_id, text FROM documents").fetchall()}


def found(spark, folder, name):
    rows = QUERIES[name](spark, folder).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r for r in rows}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, folder, texts):
    rows = found(spark, folder, "op1_pii_crf")
    assert set(rows) == set(texts)
    order = ("email", "ip", "card", "phone")
    for i, text in texts.items():
        base = sorted(plain_pii(text), key=lambda s: (order.index(s[0]), s[1]))
        spans = [f"{k}:{a}:{b}" for k, a, b in base]
        r = rows[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in order] and r.base_sha256 == digest(",".join(spans))
        every = r.spans.split(",") if r.spans else []
        assert set(spans) <= set(every) and r.n_added == len(every) - len(spans)
        for kind, a, b in (s.split(":") for s in every):
            value = text[int(a):int(b)]
            digits = [int(c) for c in value if c.isdigit()]
            if kind == "card":
                assert 13 <= len(digits) <= 19 and sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))) % 10 == 0
            assert kind != "phone" or 9 <= len(digits) <= 15


def test_op2(spark, folder, texts):
    import tokenizers
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    library.no_truncation()
    library.no_padding()
    rows = found(spark, folder, "op2_bpe_encoding")
    assert set(rows) == set(texts)
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        want = (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == want


def test_op4(spark, folder, texts):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    rows = found(spark, folder, "op4_token_counts")
    assert set(rows) == set(texts)
    for i, text in texts.items():
        n = len(library.encode(text))
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len(text.encode()), n, n > 4096)


def test_op6(spark, folder, texts):
    langs = dict(compare.duck(folder).execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = found(spark, folder, "op6_language_id")
    assert set(rows) == set(texts)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.lang_pred in {*langs.values(), "und"}
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[i]))
    asked = [i for i, r in rows.items() if r.held_out and langs[i] is not None]
    assert sum(rows[i].lang_pred == langs[i] for i in asked) > 0.95 * len(asked)


def test_op8(spark, folder, texts):
    """Every reported stretch is within its item's budget, and every text that holds an item letter by letter is reported."""
    items = {i: decontaminate.fold_one(t) for i, t in compare.duck(folder).execute("SELECT item_id, text FROM benchmark").fetchall() if t}
    rows = found(spark, folder, "op8_benchmark_leaks")
    assert set(rows) == set(texts)
    for i, text in texts.items():
        folded, r = decontaminate.fold_one(text), rows[i]
        assert {k for k, item in items.items() if item and item in folded} <= set(r["items"]) and r.n_items == len(r["items"])
        for k, distance, a, b in zip(r["items"], r.distances, r.starts, r.ends):
            near = decontaminate.fold_one(text[max(0, a - 50):b + 50])
            assert distance <= int(len(items[k]) * 0.05) and edit_distance_within(items[k], near) <= distance


def test_op9(spark, folder, texts):
    sources = dict(compare.duck(folder).execute("SELECT doc_id, source FROM documents").fetchall())
    rows = found(spark, folder, "op9_secret_ownership")
    assert set(rows) == set(texts)
    held = []
    for i, text in texts.items():
        base, r = plain_secrets(text), rows[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
        spans = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == digest(",".join(spans)) and set(spans) <= set(r.spans.split(","))
        candidates = [*secret_scan.base_spans(text), *secret_scan.mixed_spans(text, secret_scan.base_spans(text))]
        held += [(sources[i], i, s) for *_, s in candidates]
        rows[i] = (r, [s for *_, s in candidates])
    verdicts = plain_verdicts(held)
    for r, secrets in rows.values():
        want = Counter(verdicts[s] for s in secrets)
        assert (r.n_live, r.n_copied, r.n_weak) == tuple(want[v] for v in ("live", "copied", "weak"))
