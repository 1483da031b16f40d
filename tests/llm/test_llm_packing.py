import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strataline.llm import queries
from strataline.llm.packing import END, VOCABULARY, Windows, Words, pack, pieces

PATH = public_tokenizers.path(VOCABULARY)
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = [
    "a<|endoftext|>b <|startoftext|>\n\nx <|ENDOFTEXT|> y<|endoftext|> .",
    "é É x́ J̌ İ İstanbul ΣΑΣ ΟΔΟΣ'S it's don't I'LL they'Re",
    "a\x1cb\x85c\xa0d　e\x0bf\tg\r\nh i\x00j",
    "ﬀ  x 123 ١٢٣ 漢字\U0001f600 \U0001f600",
    "end. end, end!!! (end). 'end'. end.' é. x...\ny,,, a.b. c&&& d#\n",
    "Z" * 5000 + " " + "é" * 300,
    "  a  b  ",
    "'s 's. a's. 's",
    "",
]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    rng = random.Random(3)
    signs = "aAbZ é́̌ß.,'!$<|>\n\t 1٣ 漢"
    texts = ODD + ["".join(rng.choices(signs, k=rng.randrange(60))) for _ in range(3000)]
    words = Words(open(PATH, encoding="utf-8").read())
    for some in (texts[:7], texts[7:2000], texts[1000:], [None]):
        got = [np.frombuffer(x, "<u4").tolist() for x in words.ids([t and t.encode() for t in some])]
        assert got == [ids_of(tokenizer, t) for t in some]


@pytest.mark.parametrize("size", [1, 2, 7, 16, 100, 4096])
def test_windows_agree_with_a_plain_best_fit(size):
    rng = random.Random(size)
    for _ in range(20):
        lengths = sorted((rng.randint(1, size) for _ in range(300)), reverse=True)
        windows, rooms, used = Windows(size), [], Counter()
        for length in lengths:
            number, offset = windows.put(length)
            fitting = [r for r in rooms if r >= length]
            assert size - offset == (min(fitting) if fitting else size)
            assert used[number] == offset
            used[number] += length
            if fitting:
                rooms.remove(min(fitting))
            rooms.append(size - offset - length)
        assert windows.made == len(rooms) == len(used)


def checked(rows, texts, tokenizer, window):
    """rows: (key, start, length, crc, doc_tokens, sequence, offset); texts by key, each as often as it stands."""
    whole = {key: [*ids_of(tokenizer, text), END] for key, text in texts.items()}
    by_key = defaultdict(list)
    for key, start, length, crc, tokens, _, _ in rows:
        part = whole[key][start : start + length]
        assert 0 < length == len(part) <= window and tokens == len(whole[key])
        assert crc == zlib.crc32(np.array(part, "<u4").tobytes())
        by_key[key].append((start, length))
    for key, ids in whole.items():
        end = 0
        for start, length in sorted(by_key[key]):
            assert start == end
            end += length
        assert end == len(ids)
    sequences = defaultdict(list)
    for _, _, length, _, _, sequence, offset in rows:
        sequences[sequence].append((offset, length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
    return sum(map(len, whole.values())), len(sequences) * window


def test_query_packs_every_id_once_with_little_padding(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    rows = [tuple(r) for r in queries.op12_packing(spark, DATA).select(*columns).collect()]
    tokens, room = checked(rows, texts, tokenizer, 4096)
    assert room - tokens < 4096 + 0.002 * tokens


def test_shards_and_small_windows(spark, docs, tokenizer):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["red", "green", "unbelievable", "x1"], k=rng.randrange(90))) for _ in range(400)]
    made = pieces(docs(texts).repartition(5), PATH, window=32, keep_ids=True)
    packed = pack(made, window=32, shard_tokens=1500).collect()
    rows = [
        (r.row.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in packed
    ]
    tokens, room = checked(rows, dict(enumerate(texts)), tokenizer, 32)
    assert room < 1.05 * tokens
    assert len({r.sequence_id >> 32 for r in packed}) > 5
    for r in packed:
        assert r.ids == [*ids_of(tokenizer, texts[r.row.doc_id]), END][r.start : r.start + r.length]
    assert all(r.start % 32 == 0 for r in packed)


def test_awkward_documents(spark, awkward, nothing, tokenizer):
    packed = pack(pieces(awkward, PATH)).collect()
    given = awkward.collect()
    assert sum(r.start == 0 for r in packed) == len(given)
    expected = Counter((r.doc_id, len(ids_of(tokenizer, r.text)) + 1) for r in given)
    assert Counter((r.row.doc_id, r.doc_tokens) for r in packed if r.start == 0) == expected
    assert sum(r.length for r in packed) == sum(n * k for (_, n), k in expected.items())
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    assert pack(pieces(nothing, PATH)).collect() == []
