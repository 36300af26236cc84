"""Token files against encoding text by text."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brute import SF_DIR
from tabaudit.llm import queries, token_files

BYTES = public_tokenizers.path("byte_bpe_50k.json")

ODD = [
    "", " ", "a  b", "a  b", "a    b c  d", "tab\t x\r\n  y ", "it's  'quoted' 12 34x",
    "<|endoftext|> and more", "one\ntwo\n three\n\nfour \nfive,\nsix", "don't, o'clock's 3's 12.5%, (a)!?", "é,à.\nü\n\n", "x" * 5000 + " " * 300 + "y", "éè ü　　z ĳ \u0085 q", " lead", "trail ",
]


def plain(rows, tokenizer):
    """(doc_id, start, ids) in ascending order of ids, null first."""
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_tokenizer(name):
    path = public_tokenizers.path(name)
    ids, starts = token_files.Encoder(path)(pa.array([*ODD, None]))
    tokenizer = Tokenizer.from_file(path)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in [*ODD, ""]]
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == expected


def test_encoder_on_random_bytes_of_text():
    draw, path = random.Random(3), BYTES
    signs = [" ", " ", "\n", "\n", "a", "b", "Z", "7", ".", ",", "'", "s", "é", "\u00a0", "\u3000", "„", "中", "\t", "\r", "\x1c", "\u0085"]
    texts = ["".join(draw.choices(signs, k=draw.randrange(40))) for _ in range(3000)]
    ids, starts = token_files.Encoder(path)(pa.array(texts))
    encoded = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [e.ids for e in encoded]


def test_files_and_views(spark, make_docs, tmp_path):
    rows = [(n, t) for n, t in enumerate(ODD, 5)] + [(None, "null id"), (3, None), (4, "same"), (4, "same")]
    docs = make_docs(rows).repartition(3)
    files = token_files.write(docs, str(tmp_path / "t"), BYTES, seq_len=64)
    got = sorted(files.documents().collect(), key=lambda r: r.start)
    found = [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    expected = plain(rows, Tokenizer.from_file(BYTES))
    assert found == expected

    stream = [i for _, _, ids in expected for i in ids]
    manifest = sorted(files.manifest.collect())
    assert sum(r.n_ids for r in manifest) == len(stream) and sum(r.n_docs for r in manifest) == len(rows)
    seen = []
    for shard, _, n_ids in manifest:
        opened = token_files.Shard(files.folder, shard)
        assert len(opened) == -(-n_ids // 64)
        for i in range(len(opened)):
            ids, mask = opened[i]
            assert ids.dtype == np.uint16 and len(ids) == len(mask) == 64
            real = np.array(mask.to_pylist())
            assert i == len(opened) - 1 or real.all()
            assert not ids[~real].any()
            seen += ids[real].tolist()
            # Views: neither ids nor mask own memory, and reading twice gives the same place.
            again, _ = opened[i]
            assert again.ctypes.data == ids.ctypes.data and not ids.flags.owndata
        with pytest.raises(IndexError):
            opened[len(opened)]
    assert seen == stream


def test_long_text_over_many_batches(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEQUENCES_PER_BATCH", 2)
    rows = [(1, "alpha beta gamma " * 3000), (2, "end")]
    encoder, folder = token_files.Encoder(BYTES), token_files.Folder(str(tmp_path), 16)
    writer = token_files.ShardWriter(folder, 0, encoder.dtype)
    for doc_id, text in rows:
        writer.add(pa.array([doc_id]), *token_files._ended(*encoder(pa.array([text])), 0))
    writer.close(complete=True)
    shard = token_files.Shard(folder, 0)
    expected = plain(rows, Tokenizer.from_file(BYTES))
    for _, start, ids in expected:
        assert shard.ids(start, start + len(ids)).tolist() == ids
    assert shard.ids(30, 70).tolist() == [i for _, _, x in expected for i in x][30:70]


def test_failed_attempt_leaves_nothing(tmp_path):
    writer = token_files.ShardWriter(token_files.Folder(str(tmp_path)), 0, np.uint16)
    writer.close(complete=False)
    assert not list(tmp_path.iterdir())


def test_empty_table(spark, make_docs, tmp_path):
    files = token_files.write(make_docs([]), str(tmp_path / "none"), BYTES)
    assert files.manifest.count() == 0 and files.documents().count() == 0


def test_query(spark, documents):
    got = queries.all_queries()["op11_token_files"](spark, SF_DIR)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    rows = [tuple(r) for r in documents.select("doc_id", F.col("text")).collect()]
    expected = [
        (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for d, start, ids in plain(rows, Tokenizer.from_file(BYTES))
    ]
    assert sorted(map(tuple, got.collect())) == expected
