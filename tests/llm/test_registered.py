"""The registered queries over the given tables, against plain versions in Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest

from tunemill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(sf):
    return pq.read_table(f"{sf}/documents.parquet").to_pandas().sort_values("doc_id")


@pytest.fixture(scope="module")
def pages(sf):
    return pq.read_table(f"{sf}/pages.parquet").to_pandas()


def rows(spark, sf, name, key):
    return {r[key]: r for r in QUERIES[name](spark, sf).collect()}


def test_archives(spark, sf, pages):
    got = rows(spark, sf, "op1_zip_archives", "page_id")
    first = {}
    for i, html in sorted(zip(pages.page_id, pages.html)):
        first.setdefault(html, i)
    assert len(got) == len(pages)
    for i, html in zip(pages.page_id, pages.html):
        data, r = html.encode(), got[i]
        again = len(data) >= 100 and first[html] != i
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first[html]) if again else ("response", None))


def plain_counts(text):
    words = text.encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), dup, len(again)


def test_quality(spark, sf, docs):
    got = rows(spark, sf, "op2_quality_rules", "doc_id")
    labels = dict(zip(*[pq.read_table(f"{sf}/labels.parquet").to_pandas()[c] for c in ("doc_id", "quality")]))
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text):
        r, plain = got[i], plain_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain
        assert r.base_failed == (plain[0] < 50 or 100 * plain[4] > 50 * plain[0])
        assert not (r.kept and r.base_failed)
    good = [got[i].kept for i, q in labels.items() if q and not got[i].base_failed]
    assert sum(good) >= 0.98 * len(good)


def test_token_counts(spark, sf, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = rows(spark, sf, "op3_token_counts", "doc_id")
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text):
        n = len(model.encode(text))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(text.encode()), n, n > 4096)


def test_fingerprints(spark, sf, docs):
    got = rows(spark, sf, "op5_multiset_fingerprints", "doc_id")
    texts = list(docs.text)
    for i, text, following in zip(docs.doc_id, texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (sorted(text.split("\n")) == sorted(changed.split("\n")))
    by_text = defaultdict(set)
    for i, text in zip(docs.doc_id, texts):
        by_text[text].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert len({x for v in by_text.values() for x in v}) == len({tuple(sorted(t.split("\n"))) for t in texts})
    longer = [r for r in got.values() if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in longer) > 0.9 * len(longer)


def test_byte_bpe(spark, sf, docs):
    import base64

    import numpy as np
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, sf, "op6_byte_bpe", "doc_id")
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text):
        ids = plain.encode_ordinary(text)
        r = got[i]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.same_text


def library_ids(docs):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [np.array(e.ids + [0], "<u4") for e in tokenizer.encode_batch(list(docs.text), add_special_tokens=False)]


def test_token_files(spark, sf, docs):
    got, start = rows(spark, sf, "op7_token_files", "doc_id"), 0
    assert len(got) == len(docs)
    for i, ids in zip(docs.doc_id, library_ids(docs)):
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_simhash(spark, sf, docs):
    import xxhash

    got, prints = rows(spark, sf, "op8_simhash", "doc_id"), {}
    for i, text in zip(docs.doc_id, docs.text):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[i].fingerprint == f"{prints[i]:016x}"
    parent = {i: i for i in prints}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {i: r.component_id for i, r in got.items()} == {i: find(i) for i in prints}


def test_packing(spark, sf, docs):
    lengths, out = dict(zip(docs.doc_id, library_ids(docs))), defaultdict(list)
    places = defaultdict(list)
    for r in QUERIES["op9_best_fit"](spark, sf).collect():
        out[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert set(out) == set(lengths)
    for i, pieces in out.items():
        at, ids = 0, lengths[i]
        for p, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (p, at)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.length == 2048 or p == 0
            at += r.length
        assert at == len(ids)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.03 * sum(map(len, lengths.values())) / 2048 + 8


def test_languages(spark, sf, docs):
    got = rows(spark, sf, "op10_languages", "doc_id")
    assert len(got) == len(docs)
    right = total = 0
    for i, lang in zip(docs.doc_id, docs.lang):
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        if r.held_out and lang:
            total += 1
            right += r.lang_pred == lang
    assert right >= 0.95 * total
