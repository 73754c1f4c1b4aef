import zlib
from collections import defaultdict

import numpy as np
import pytest
from pairsmith.llm import binary_records, packing, tokens
from pairsmith.llm.tables import new_path, written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokens.default_path())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(given, plain, monkeypatch):
    odd = ["", " ", "a ", " a", "a  b\n\n c ", "\n", "it's we'll <|endoftext|> <|endoftext|>", "a \x1c b", "日本 語　x", "a\x85 b", "ﬁ Ⅷ ²x", "a\r\n b", "x ​ y", "tab\t tab"]
    monkeypatch.setattr(tokens, "REMEMBERED", 300)  # the memory is emptied often
    encoder = tokens.Encoder(tokens.default_path())
    texts = [*odd, *given.values()]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, encoder.dtype).tolist() == plain(text), text


def test_records_in_order_and_shuffled(spark, given, plain):
    got, start = {r.doc_id: r for r in binary_records.op5_binary_records(spark, SF).collect()}, 0
    ids = {k: plain(given[k]) + [0] for k in given}
    for k in sorted(given):
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(ids[k]), zlib.crc32(np.array(ids[k], "<u4").tobytes()))
        start += len(ids[k])
    folder = new_path(spark, "records")
    index = binary_records.write(spark.read.parquet(f"{SF}/documents.parquet"), folder)
    rows = binary_records.read_shuffled(index, folder, 7).collect()
    assert {r.doc_id: r.ids for r in rows} == ids and [r.doc_id for r in rows] != sorted(given)


def test_damaged_records_are_refused():
    import io
    good = binary_records.frame(5, np.arange(9, dtype="<u2").tobytes(), 2)
    doc_id, ids = binary_records.parse(binary_records.read_frame(io.BytesIO(good)))
    assert doc_id == 5 and ids.tolist() == list(range(9))
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            binary_records.read_frame(io.BytesIO(bytes(bad)))
    with pytest.raises(ValueError):
        binary_records.read_frame(io.BytesIO(good[:-3]))


def test_odd_rows(spark, odd, nothing):
    folder = new_path(spark, "records")
    rows = binary_records.read_in_order(binary_records.write(odd, folder), folder).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3, 4, 5, 6, 6, 7, 8, 9] and {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {1}
    folder = new_path(spark, "records")
    assert binary_records.read_in_order(binary_records.write(nothing, folder), folder).count() == 0
    assert packing.pack_documents(odd).select("doc_id").distinct().count() == 10 and packing.pack_documents(nothing).count() == 0


def test_packing_is_gapless_and_full(spark, given, plain):
    rows, sequences, documents = packing.op7_best_fit_packing(spark, SF).collect(), defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append(r)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE
    total = 0
    for k, parts in documents.items():
        ids, at = np.array(plain(given[k]) + [0], "<u4"), 0
        for i, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == packing.SEQUENCE)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
        total += at
    assert documents.keys() == given.keys() and len(sequences) <= -(-total // packing.SEQUENCE) + 1


def test_sequences_hold_the_ids(spark, given, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = packing.pack(written(packing.pieces(docs, with_ids=True), "pieces"))
    assert sorted(x for r in packing.sequences(packed).collect() for x in r.ids) == sorted(x for t in given.values() for x in [*plain(t), 0])


@pytest.mark.parametrize("histogram", [{}, {5: 3}, {10: 1, 7: 2, 3: 5, 1: 1}, {6: 100_000_000, 4: 100_000_001}, {k: k for k in range(1, 11)}])
def test_plan_places_every_piece_once(histogram):
    rows, fill = packing.plan(dict(histogram), 10), defaultdict(int)
    for length, count in histogram.items():
        ranges = sorted((a, b) for k, a, b, *_ in rows if k == length)
        assert ranges[0][0] == 0 and ranges[-1][1] == count and all(x[1] == y[0] for x, y in zip(ranges, ranges[1:]))
    for length, _, _, first, each, _ in rows:
        fill[first] += length * each
    assert all(f <= 10 for f in fill.values())


def test_fullest_equals_brute_force():
    import itertools
    import random
    draw = random.Random(3)
    for _ in range(200):
        left = sorted({draw.randint(1, 12): draw.randint(1, 3) for _ in range(4)}.items(), reverse=True)
        room = draw.randint(0, 30)
        sums = {sum(n * k for n, (k, _) in zip(c, left)) for c in itertools.product(*[range(n + 1) for _, n in left])}
        got = packing.fullest(room, left)
        assert sum(k * n for k, n in got) == max(s for s in sums if s <= room) and all(n <= dict(left)[k] for k, n in got)


def test_added_tokens_in_a_text_are_what_the_library_makes_of_them(spark):
    from tokenizers import Tokenizer
    untouched, end = Tokenizer.from_file(tokens.default_path()), "<|endoftext|>"
    texts = ["a b", f"a {end} b", end, f"x{end}{end} y  {end}\n", "<|endoftext| >", f"{end} after"]
    ids = [[*untouched.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert ids[1] == [64, 220, 50256, 275, 0]
    docs, folder = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), new_path(spark, "records")
    got = {r.doc_id: r.ids for r in binary_records.read_shuffled(binary_records.write(docs, folder), folder, 7).collect()}
    assert got == dict(enumerate(ids))
    pieces = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pieces(docs).collect()}
    assert pieces == {k: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(ids)}


class Counting:
    """A tokenizer that counts the calls of its library."""

    def __init__(self, inner):
        self.inner, self.model, self.calls = inner, self, 0

    def encode_batch_fast(self, texts, **options):
        self.calls += 1
        return self.inner.encode_batch_fast(texts, **options)

    def tokenize(self, text):
        self.calls += 1
        return self.inner.model.tokenize(text)


def test_the_library_meets_a_unit_once_not_once_a_text(plain):
    encoder = tokens.Encoder(tokens.default_path())
    encoder.tokenizer = Counting(encoder.tokenizer)
    marks = [".", ",", "!?", "\n", " (", ") ", " 12 "]
    texts = [f"{a}{m}{b} {a}{m}" for a in ("One", "zwölf", "très") for b in ("or", "oder", "ou") for m in marks] * 20
    got = encoder.encode(texts)
    assert all(np.frombuffer(g, encoder.dtype).tolist() == plain(t) for t, g in zip(texts, got))
    assert encoder.tokenizer.calls < 50
    before = encoder.tokenizer.calls
    encoder.encode(texts[::-1])
    assert encoder.tokenizer.calls == before


@pytest.mark.parametrize("slots", [16, 1 << 12])
def test_units_are_cut_where_the_vocabulary_parts_a_text(plain, monkeypatch, slots):
    import random
    monkeypatch.setattr(tokens, "REMEMBERED", slots)  # 16: units push each other out within a batch
    encoder, draw = tokens.Encoder(tokens.default_path()), random.Random(5)
    atoms = [*"abZ09 .,'!-\n\t\r\x0b\x00\x1c\x7f\x85\xa0×÷ßÀɏʔ日。　“ ​᠎é́²ж🙂", " ", "'s", "'ll", "  ", "\n\n", "word", "extraordinarily", "aÃ×Ĺ", "x" * 70, "日本語" * 9]
    texts = ["".join(draw.choices(atoms, k=draw.randint(0, 30))) for _ in range(2000)]
    for i in range(0, len(texts), 100):
        for text, ids in zip(texts[i:i + 100], encoder.encode(texts[i:i + 100])):
            assert np.frombuffer(ids, encoder.dtype).tolist() == plain(text), text
    assert len(encoder.long) <= slots >> 3 and max(map(len, encoder.long), default=0) <= tokens.LONG
    data = "We'll go.\nNow  12×3".encode()
    starts = tokens.units(data, np.array([0])).tolist()
    assert [data[a:b].decode() for a, b in zip(starts, [*starts[1:], len(data)])] == ["We", "'ll", " go", ".", "\n", "Now", "  12×3"]


def test_records_hold_the_ids_of_awkward_units(spark):
    from tokenizers import Tokenizer
    untouched = Tokenizer.from_file(tokens.default_path())
    texts = [None, "", " ", "3×4÷2 a×b", "x" * 200 + " y", "日本語の長い文字列です。" * 20, "слово, слово's", "“we’ll”\n\n 'll's\r\n", "a\xa0\n b\x85 c", "word " * 5000, "<|endoftext|>word"]
    docs, folder = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), new_path(spark, "records")
    index, start = binary_records.write(docs, folder), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in binary_records.read_in_order(index, folder).collect()}
    for k, text in enumerate(texts):
        ids = np.array([*untouched.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert got[k] == (start, len(ids), zlib.crc32(ids.tobytes())), text
        start += len(ids)
