"""Nulls, empty and long texts, ties, repeated rows, empty tables and further columns, for each operator and stage."""

import hashlib
import random
import zipfile

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tunemill.llm import counts, languages, multiset, packing, quality, rans, simhash, transducer, urls, warc
from tunemill.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, piece string, `row` long, q string"
LONG = "wort " * 9000 + "x" * 30_000
TEXTS = [None, "", " ", "\n\n", "one", "One\ttwo  three \n four", LONG, "a b c d e f " * 30, "a b c d e f " * 30, "<|endoftext|> é日本 ①"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None, 7, "p", 3, "z") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, "one", "en", None, 1, 1, "p", 1, "q")], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def every(df, spark):
    vocabulary = P.path("byte_bpe_50k.json")
    rules = spark.sql("SELECT 'com' AS host, '/' AS path, 'allow' AS verdict")
    counted = quality.with_counts(df)
    return {
        "warc": warc.read_records(warc.write_packages(df, warc.package_folder(spark), "doc_id", "source", "text"), "doc_id"),
        "quality": quality.judged(counted, quality.thresholds(counted, ["lang", "source"]), ["lang", "source"]),
        "counts": counts.token_counts(df, P.path("piece_bpe_32k.model"), chunk=1000),
        "urls": urls.judge(df, rules, "doc_id", "text"), "multiset": multiset.fingerprints(df),
        "transducer": transducer.round_trip(df, P.path("byte_bpe_multi_50k.tiktoken")),
        "rans": rans.read_documents(rans.write_files(df, rans.token_folder(spark), vocabulary, file_ids=50)),
        "simhash": simhash.clustered(df), "packing": packing.packed(df, vocabulary, capacity=64), "languages": languages.predicted(df)}


def test_empty_tables(none, spark):
    assert {name: out.count() for name, out in every(none, spark).items() if out.count()} == {}
    docs = none
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0, name


def test_odd_rows(odd, spark):
    n = odd.count()
    for name, out in every(odd, spark).items():
        got = out.collect()
        assert len(got) == n or name == "packing", name
        if name == "counts":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
            assert {(r.doc_id, r.n_tokens) for r in got} == {(r.doc_id, len(model.encode(r.text or ""))) for r in odd.collect()}
        if name == "transducer":
            assert all(r.same_text for r in got)
        if name == "simhash":
            one = {r.doc_id: r for r in got}
            assert one[0].fingerprint == "0" * 16 and one[1].component_id == 0 and one[8].component_id == 7
        if name == "languages":
            assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2, 3)} == {"und"}


def test_stages_keep_columns(odd, spark):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, "").columns == odd.columns


def test_stage_keeps_one_of_each(spark):
    words = [f"w{i}" for i in range(300)]
    near = words.copy()
    near[150] = "changed"
    other = [f"v{i}" for i in range(300)]
    df = spark.createDataFrame([(5, " ".join(words)), (3, " ".join(near)), (3, " ".join(near)), (9, " ".join(other))], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == [3, 9]


def test_transducer_equals_merging():
    ranks = transducer.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    machine, rng = transducer.Transducer(ranks), random.Random(1)
    for _ in range(3000):
        piece = bytes(rng.choice(b" aetinorsh\xc3\xa9\xa8") for _ in range(rng.randint(1, 24)))
        want = [ranks[piece]] if piece in ranks else [ranks[t] for t in transducer.merge(piece, ranks)]
        assert machine.encode(piece) == want


def test_stream_waits_for_whole_characters():
    data = "aé日😀z".encode()
    for step in (1, 2, 3, 5):
        stream = transducer.Utf8Stream()
        assert "".join(stream.feed(data[i:i + step]) for i in range(0, len(data), step)) + stream.close() == "aé日😀z"
    assert transducer.Utf8Stream().feed(b"\xffa") == "�a"


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 300_000])
def test_rans_round_trip(n, tmp_path):
    ids = np.minimum(np.random.default_rng(n).geometric(0.01, n), 50_000).astype("<u4")
    (tmp_path / "f").write_bytes(rans.file_bytes(ids, [(1, n)]))
    file = rans.TokenFile(str(tmp_path / "f"))
    assert (np.concatenate(list(file.parts(0))) == ids).all()
    if n < 2048:  # a damaged lane that codes next to nothing may still give the right ids
        return
    damaged = bytearray((tmp_path / "f").read_bytes())
    damaged[file.blocks[0][0] + 1] ^= 255
    (tmp_path / "g").write_bytes(bytes(damaged))
    with pytest.raises(ValueError):
        list(rans.TokenFile(str(tmp_path / "g")).parts(0))


def test_zip64_directory(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    writer = warc.PackageWriter(str(tmp_path))
    payload = b"x" * 200
    writer.add(1, warc.record(1, "http://a/", payload, hashlib.sha256(payload).hexdigest(), None, 200))
    path, _ = writer.close()
    from pyarrow import fs

    with fs.LocalFileSystem().open_input_file(path) as file:
        members = warc.directory(file)
        (head, found), = warc.read_range(file, *warc.stored(members, warc.RECORDS))
    assert found == payload and head["warc-type"] == "response" and set(members) == {warc.RECORDS, warc.INDEX, "datapackage.json"}


def test_fingerprints_add_and_subtract(spark):
    df = spark.sql("SELECT 'a.\nb. c.' AS x, 'd.' AS y, 'd.\nb. c.\na.' AS xy")
    whole, x, y = (multiset.fingerprint(F.col(c)) for c in ("xy", "x", "y"))
    row = df.select((multiset.add(x, y) == whole).alias("joined"), (multiset.subtract(whole, y) == x).alias("cut")).first()
    assert row.joined and row.cut


def test_components_of_a_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = components(edges).collect()
    assert len(got) == 201 and {r.root for r in got} == {0}


def test_counts_of_tables_in_changing_order(spark):
    """Rows that are read in another order each time keep their own counts."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(("ab", "wort", "é日", "x" * 9, "\n")) for _ in range(rng.randint(100, 900)))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: len(model.encode(t)) for i, t in rows}
    grouped = df.groupBy("doc_id").agg(F.first("text").alias("text"))
    for table in (df.repartition(7), grouped, df.where("doc_id % 2 = 0").union(df.where("doc_id % 2 = 1").repartition(3)), df.orderBy(F.desc("text"))):
        got = {r.doc_id: r.n_tokens for r in counts.token_counts(table, P.path("piece_bpe_32k.model"), chunk=500).collect()}
        assert got == want


def test_package_with_a_comment_and_full_count(tmp_path):
    """An end mark within the comment is none, and 65,535 members need no ZIP64 end."""
    from pyarrow import fs

    path = str(tmp_path / "p.zip")
    with zipfile.ZipFile(path, "w") as z:
        for i in range(65_535):
            z.writestr(f"{i}", b"x" if i == 7 else b"")
        z.comment = b"note PK\x05\x06" + b"\0" * 30
    with fs.LocalFileSystem().open_input_file(path) as file:
        members = warc.directory(file)
        offset, size = warc.stored(members, "7")
        assert len(members) == 65_535 and file.read_at(size, offset) == b"x"


def test_ranges_of_many_records(tmp_path):
    writer = warc.PackageWriter(str(tmp_path))
    payloads = [bytes([i % 256]) * (i % 3000) for i in range(400)] + [random.Random(1).randbytes(200_000), b""]
    for i, data in enumerate(payloads):
        writer.add(i, warc.record(i, "http://a/", data, hashlib.sha256(data).hexdigest(), None, len(data)))
    path, _ = writer.close()
    from pyarrow import fs

    with fs.LocalFileSystem().open_input_file(path) as file:
        offset, size = warc.stored(warc.directory(file), warc.RECORDS)
        assert [found for _, found in warc.read_range(file, offset, size)] == payloads
        with pytest.raises(ValueError):
            list(warc.read_range(file, offset, size - 5))
