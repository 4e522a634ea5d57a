import json
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import TEXTS, documents, plain
from martbrook.llm import range_coder as rc, token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def shapes(n):
    pick = np.random.default_rng(n)
    return [pick.integers(0, rc.MOST_ID + 1, n), np.zeros(n, int), pick.integers(0, 3, n), np.arange(n) % 97 * 513,
            np.minimum(pick.zipf(1.3, n), rc.MOST_ID), np.full(n, rc.MOST_ID)]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000])
def test_blocks_round_trip_and_stand_alone(n):
    for ids in shapes(n):
        blocks = rc.encode_blocks(ids, 64)
        assert (rc.decode_blocks(blocks, 64) == ids).all() and len(blocks) == -(-n // 64)
        for k in range(0, len(blocks), 5):
            assert (rc.decode_blocks(blocks[k:k + 1], 64) == ids[64 * k:64 * k + 64]).all()


def test_groups_of_lanes_change_nothing(monkeypatch):
    ids = shapes(1000)[4]
    before = rc.encode_blocks(ids, 64)
    monkeypatch.setattr(rc, "LANES", 3)
    assert rc.encode_blocks(ids, 64) == before and (rc.decode_blocks(before, 64) == ids).all()


def test_groups_of_lanes_are_even(monkeypatch):
    """A step costs its calls, however few lanes it has, so no group is left with one block."""
    lanes, decode = [], rc._decode
    monkeypatch.setattr(rc, "LANES", 4)
    monkeypatch.setattr(rc, "_decode", lambda data, steps: lanes.append(len(data)) or decode(data, steps))
    ids = shapes(1000)[2][:5 * 64]
    assert (rc.decode_blocks(rc.encode_blocks(ids, 64), 64) == ids).all() and sorted(lanes) == [2, 3]


def test_class_frequencies_round_down():
    """Sixteen-bit arithmetic modulo 2**16 gives what wide signed arithmetic does, to the ends of the range."""
    pick, model = np.random.default_rng(2), rc._Model(3)
    rows = model.classes.T.astype(np.int64)
    for step in range(3000):
        kinds, missed = pick.integers(0, rc.CLASSES, 3), pick.random(3) < 0.8
        kinds[0], kinds[1], missed[:2] = 0, rc.CLASSES - 1, True
        goal = np.where(np.arange(rc.CLASSES + 1) > kinds[:, None], rc._SPREAD, 0)
        rows = np.where(missed[:, None], rows + ((goal - rows) >> rc._RATE), rows)
        model.learn_class(kinds.astype(np.uint8), missed)
        assert (model.classes.T == rows).all()


def test_prediction_pays():
    text = np.tile(np.random.default_rng(1).integers(0, 50_000, 100), 40)
    assert sum(len(b[2]) for b in rc.encode_blocks(text)) < 0.4 * 2 * len(text)  # two bytes an id
    assert sum(len(b[2]) for b in rc.encode_blocks(np.zeros(4096, int))) < 100


def test_most_frequent_id_is_predicted_without_context():
    model = rc._Model(2)
    for now in ([5, 9], [7, 9], [5, 8], [6, 9], [5, 4]):
        model.learn(np.array(now), model.predict()[0] == np.array(now))
    model.last = np.array([40_001, 40_001])  # not seen before
    model.before = np.array([40_002, 40_002])
    assert model.predict()[0].tolist() == [5, 9]


def test_a_context_is_read_and_written_once_a_step():
    """An entry holds the id and how often it was right, so a step gathers one array for each order."""
    model, ids = rc._Model(3), np.array([0, 7, rc.MOST_ID])
    assert [e.dtype.itemsize * len(e) for e in model.entries] == [4 * 3 * rc._SLOTS] * 2
    for _ in range(20):  # trust is bounded, and the largest id fits
        model.learn(ids, model.predict()[0] == ids)
    assert model.predict()[0].tolist() == ids.tolist()
    assert [t.tolist() for t in model.trust] == [[rc._STATES - 1] * 3] * 2 and [k.tolist() for k in model.known] == [ids.tolist()] * 2


def test_bytes_stay_as_they_were():
    pick = np.random.default_rng(5)
    ids = np.minimum(pick.zipf(1.2, 20_000), rc.MOST_ID)
    data = b"".join(b[2] for b in rc.encode_blocks(ids))
    assert (len(data), zlib.crc32(data)) == (23738, 1645103371)


def test_damage_and_wrong_ids_are_noticed():
    ids = shapes(200)[0]
    (n, check, data), *rest = rc.encode_blocks(ids, 64)
    with pytest.raises(ValueError):
        rc.decode_blocks([(n, check, data[:20] + bytes([data[20] ^ 1]) + data[21:]), *rest], 64)
    for bad in ([-1], [rc.MOST_ID + 1]):
        with pytest.raises(ValueError):
            rc.encode_blocks(np.array(bad))


def test_file_round_trip():
    ids = [np.array([1, 2, 3]), np.array([], dtype=int), np.array([70_000])]
    data = tf.pack(["a", None, "é"], ids)
    docs, back = tf.unpack(data)
    assert docs == ["a", None, "é"] and [b.tolist() for b in back] == [i.tolist() for i in ids]
    assert tf.unpack(tf.pack([], [])) == ([], [])
    coded = len(rc.encode_blocks(np.concatenate(ids))[0][2])
    for at in (3, 50, len(data) - coded):
        with pytest.raises(ValueError):
            tf.unpack(data[:at] + bytes([data[at] ^ 255]) + data[at + 1:])


def test_cut_texts_as_the_library(library, monkeypatch):
    monkeypatch.setattr(tf, "PIECES", 40)
    of = tf.TextIds(tf.read_model(None, PATH))
    pick = np.random.default_rng(3)
    signs = np.array(["a", "the", "ing", " ", " ", "  ", "\n", "\t", "é", "中", "1", "!", "'s", " ", "\x00", "<|endoftext|>"])
    texts = ["".join(pick.choice(signs, pick.integers(0, 12))) for _ in range(3000)]
    assert [x.tolist() for at in range(0, 3000, 100) for x in of(texts[at:at + 100])] == [library(t) for t in texts]


def test_pieces_are_cut_where_matches_begin_anew():
    def pieces(*texts):
        found, first = tf._pieces(pa.array([t.encode() for t in texts], pa.binary()))
        return [[p.as_py().decode() for p in found[a:b]] for a, b in zip(first, first[1:])]

    assert pieces("The cat's café, x", "", "a  b") == [["The", " cat", "'s", " café", ",", " x"], [], ["a", "  b"]]
    assert pieces("one.\nTwo \n x\u00a0 y 2×, ") == [["one", ".", "\nTwo", " \n x\u00a0", " y", " 2×,", " "]]
    assert pieces("x\u3000  y", "é ÷, z") == [["x\u3000  y"], ["é", " ÷,", " z"]]


def test_a_word_is_tokenised_once_whatever_follows_it():
    of = tf.TextIds(tf.read_model(None, PATH))
    words, lists = of.words, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            lists.extend(texts)
            return words.encode_batch_fast(texts, **options)

    of.words = Counted()
    for _ in range(2):
        of(["an oak, an oak. an oak\nan oak's", "an oak; an oak"])
    assert [sorted(x) for x in lists] == [["an", "Ġan", "Ġoak"]]


def test_other_pre_tokenisers_get_whole_texts():
    spec = json.loads(tf.read_model(None, PATH))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    tokenizer, texts = Tokenizer.from_str(json.dumps(spec)), ["one two, one", "", "two\none"]
    assert [x.tolist() for x in tf.TextIds(json.dumps(spec))(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_unusual_signs_as_the_library(library, monkeypatch):
    """White space, letters and signs in and out of ASCII and Latin-1, in each order."""
    monkeypatch.setattr(tf, "WINDOW", 7)
    of = tf.TextIds(tf.read_model(None, PATH))
    pick = np.random.default_rng(4)
    signs = np.array([*"aZ9 _,'\"\n\r\x0b\x1c\x7f\u0085\u00a0\u2003\u3000×÷ªéÀÿſΩ٣²¿中。\u200b\ufeff🙂", "e\u0301", " b", "'re", ".\n"])
    texts = ["".join(pick.choice(signs, pick.integers(1, 9))) for _ in range(10_000)]
    assert [x.tolist() for x in of(texts)] == [library(t) for t in texts]


def brute(rows, library, end_id):
    out, start = [], 0
    for i, text in rows:
        ids = np.array([*library(text), end_id], dtype="<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_awkward_texts(spark, tmp_path, library):
    rows = sorted(enumerate(TEXTS), key=lambda r: r[0])
    docs = documents(spark, folder=tmp_path)
    assert plain(tf.id_checksums(docs, PATH)) == brute(rows, library, 0)
    folder = str(tmp_path / "small")
    manifest = tf.write_ids(docs, folder, PATH, end_id=5, file_ids=50)
    assert manifest.count() > 4
    back = tf.read_ids(manifest, docs.schema["doc_id"].dataType)
    assert plain(back, "doc_id", "ids") == [(i, [*library(t), 5]) for i, t in rows]
    assert plain(back, "doc_id", "start") == [r[:2] for r in brute(rows, library, 5)]


def test_null_and_repeated_ids_and_empty_tables(spark, tmp_path, library):
    docs = documents(spark, ["b", "a", "a", None], [3, 3, 3, None], tmp_path)
    found = plain(tf.id_checksums(docs, PATH), "start", "doc_id", "n_tokens")
    assert found == [(0, None, 1), (1, 3, 2), (3, 3, 2), (5, 3, 2)]
    assert tf.id_checksums(documents(spark, [], folder=tmp_path), PATH).count() == 0
