"""Token counts, packing and matrices against the tokenizer library."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerflow.llm import kernels as K
from ledgerflow.llm import packing, token_counts, token_matrix, tokens

ODD = "abc The's 're'LL <|endoftext|> <|startoftext|> \t \x0b \x85   　 \x1c \x00 ­ Éé é İI Σσς ß 日本語 1²٣ ½ \U0001f600 ‍ Å $$$".split(" ")


def _odd_texts(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice([*ODD, " ", "\n", "x"]) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.resolve("word_bpe_49k.json"))


def test_ids_and_counts_equal_the_library_on_odd_texts(monkeypatch):
    lib, path = _library(), tokens.resolve("word_bpe_49k.json")
    enc, cnt = tokens.Encoder(path), token_counts.MergeCounter(path)
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)  # the caches start anew again and again
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 50)
    for text in _odd_texts(1500):
        want = lib.encode(text, add_special_tokens=False).ids
        data, offs = K.text_buffers(pa.array([text]))
        got = np.frombuffer(b"".join(enc.ids(data, 0, int(offs[1]))), "<u4").tolist()
        assert got == want, text
        assert sum(map(cnt.__getitem__, text.encode().split())) == len(want) == cnt.count(text), text


def test_a_very_long_word_and_a_long_text():
    lib, path = _library(), tokens.resolve("word_bpe_49k.json")
    cnt = token_counts.MergeCounter(path)
    word = "".join(random.Random(2).choices("abcdefgh", k=5000))
    assert cnt.count(word) == len(lib.encode(word, add_special_tokens=False).ids)
    data = np.frombuffer(b"ab cd\n" * 2000, np.uint8)
    tokens_, tokens.PIECE_BYTES = tokens.PIECE_BYTES, 100
    try:
        assert b"".join(tokens.text_pieces(data, 0, len(data))) == data.tobytes()
        assert all(len(p) < 120 for p in tokens.text_pieces(data, 0, len(data)))
    finally:
        tokens.PIECE_BYTES = tokens_


def _docs(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices(["alpha", "beta", "Gamma!", "x1", "été"], k=rnd.choice([0, 1, 5, 300, 3000]))), i, "s") for i in range(120)]
    rows += [(7, rows[7][1], 0, "again"), (None, "no id here", 1, None), (500, None, 1, None), (501, "", 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard long, n_tokens string").repartition(3)


def test_counts_of_a_table(spark):
    lib, docs = _library(), _docs(spark)
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = token_counts.count_tokens(docs, limit=300)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 300) for r in rows)
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def _check_pieces(pieces, docs, lib, final=(1,)):
    """Every document's ids lie in its pieces, each once; sequences are gapless and at most 2048 long."""
    want = {}
    for r in docs:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + list(final)
        want.setdefault((r.doc_id, len(ids)), []).append(ids)
    by_seq = {}
    for doc, start, ids, seq, offset in pieces:
        by_seq.setdefault(seq, []).append((offset, len(ids)))
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= 2048
    total = sum(len(p[2]) for p in pieces)
    assert total == sum(len(ids) for lists in want.values() for ids in lists)
    flat = {(doc, start + k, i) for doc, start, ids, _, _ in pieces for k, i in enumerate(ids)}
    assert flat == {(doc, k, i) for (doc, _), lists in want.items() for ids in lists for k, i in enumerate(ids)}
    return by_seq


def test_cost_balanced_packing(spark):
    docs = _docs(spark)
    packed = packing.pack_documents(docs, block_tokens=20_000)
    rows = packed.withColumn("crc", F.crc32("ids")).collect()
    assert all(r.length == len(r.ids) // 4 and r.crc == zlib.crc32(r.ids) for r in rows)
    pieces = [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist(), r.sequence_id, r.offset) for r in rows]
    by_seq = _check_pieces(pieces, docs.collect(), _library())
    padding = sum(2048 - sum(n for _, n in parts) for parts in by_seq.values())
    assert padding <= 0.1 * 2048 * len(by_seq)
    totals = {}
    for r in rows:
        totals.setdefault((r.doc_id, r.doc_tokens), 0)
    assert packing.pack_documents(docs.limit(0)).count() == 0
    assert packing.pack_documents(docs.where("doc_id = 500"), final_id=None).count() == 0


def test_balance_uses_the_fewest_sequences_and_evens_out_their_cost():
    rnd = random.Random(4)
    for _ in range(50):
        lengths = [rnd.randint(1, 99) for _ in range(rnd.randint(1, 60))]
        placed = packing.balance(lengths, 100, 1.0, 0.01)
        used = {}
        for i, start, n, s, offset in placed:
            used.setdefault(s, []).append((offset, n))
        assert len(used) <= -(-sum(lengths) // 100)
        for parts in used.values():
            assert sum(n for _, n in parts) <= 100
        for i, n in enumerate(lengths):
            spans = sorted((start, m) for j, start, m, _, _ in placed if j == i)
            assert sum(m for _, m in spans) == n and spans[0][0] == 0
    cost = {}
    for i, _, n, s, _ in packing.balance([50] * 8 + [25] * 16, 200, 1.0, 0.1):
        cost[s] = cost.get(s, 0) + n + 0.1 * n * n
    assert max(cost.values()) <= 1.5 * min(cost.values())


def test_segment_tree_finds_what_a_search_over_all_finds():
    rnd = random.Random(3)
    for _ in range(200):
        capacity = rnd.choice([7, 8, 33])
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 40))]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fit = [(r, k) for k, r in enumerate(rooms) if r >= n]
            if fit:
                rooms[min(fit)[1]] -= n
            else:
                rooms.append(capacity - n)
        got = token_matrix.best_fit(lengths, capacity)
        assert sorted(capacity - sum(lengths[i] for i in g) for g in got) == sorted(rooms)
        assert sorted(i for g in got for i in g) == list(range(len(lengths)))


def test_matrix_round_trip(spark, tmp_path):
    docs = _docs(spark)
    packed = token_matrix.pack_matrices(docs, block_tokens=20_000)
    token_matrix.write_matrices(packed, str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    pieces = []
    for r in rows:
        ids, pos = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(pos) == 2048 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert not ids[r.n_tokens :].any() and not pos[r.n_tokens :].any()
        for doc, start, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            assert pos[a:b].tolist() == list(range(b - a))
            pieces.append((doc, start, ids[a:b].tolist(), r.sequence_id, a))
    assert len({r.sequence_id for r in rows}) == len(rows)
    _check_pieces(pieces, docs.collect(), _library())
    assert token_matrix.pack_matrices(docs.limit(0)).count() == 0


def test_an_idle_packing_worker_keeps_one_generation_of_its_cache(monkeypatch):
    import pyarrow as pa

    from ledgerflow.llm import packing
    from ledgerflow.llm.tokens import encoder, resolve

    path = resolve("word_bpe_49k.json")
    monkeypatch.setattr(packing, "CHUNKS", 50)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [" ".join(f"word{i}" for i in range(500))]})
    pieces = list(packing._pack(path, 2048, 1, 1.0, 1.0 / 6144, 1 << 20)(iter([batch])))
    chunks = encoder(path, 50).chunks
    assert sum(b.num_rows for b in pieces) == 1 and len(chunks) <= 50 and not chunks.old


def test_texts_of_a_column_equal_the_library_whatever_the_window(monkeypatch):
    lib, path = _library(), tokens.resolve("word_bpe_49k.json")
    texts = [*_odd_texts(400), "", None, "\0", "a \0 b\0 \0", " ", "x" * 90 + " " + "y" * 9000, "\x1cz", "<|endoftext|>", "Ⱥⱦ İİ", None, ""]
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 20)
    for window in (1, 64, 1 << 21):
        monkeypatch.setattr(tokens, "WINDOW_BYTES", window)
        data, offs = K.text_buffers(pa.array(["cut off", *texts])[1:])
        got = list(tokens.Encoder(path).texts(data, offs))
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert list(tokens.Encoder(path).texts(*K.text_buffers(pa.array([None, ""])))) == [b"", b""]


def test_matrices_search_a_batch_for_words_at_once_and_keep_frequent_chunks(monkeypatch):
    path = tokens.resolve("word_bpe_49k.json")
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 40)
    enc, calls = tokens.Encoder(path), []
    monkeypatch.setitem(tokens._ENCODERS, (path, None), enc)

    def counting(find):
        return lambda text: calls.append(text) or find(text)

    for name in ("find", "find_ascii"):
        if hasattr(enc.chunks, name):
            monkeypatch.setattr(enc.chunks, name, counting(getattr(enc.chunks, name)))
    often = [f"Often{i}" for i in range(30)]
    for part in range(4):  # many words that come once, between words that come back
        text = " ".join([*often, *often, *(f"once{part}x{i}" for i in range(60))])
        batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [text, text]})
        assert sum(b.num_rows for b in token_matrix._pack(path, 2048, 1, 0, 1 << 20)(iter([batch]))) == 1
    assert len(calls) == 4
    assert sum("often" in c for c in calls) == 1
    assert len(enc.chunks) <= 80
