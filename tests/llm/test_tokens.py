"""Piece encoding, token files and fingerprints against the libraries and brute force."""

import hashlib
import io
import zlib

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from curatrix.llm import fingerprints as fp  # noqa: E402
from curatrix.llm import piece_tokens as pt  # noqa: E402
from curatrix.llm import token_store as ts  # noqa: E402
from curatrix.llm.common import shared_dir  # noqa: E402

TEXTS = [
    None, "", " ", "  a  b ", "\n", "\n\n x", "▁", "a▁b", "日本語テキスト" * 50, "\x00a", "é  x　y", "<s></s><unk><0x0A>", "a" * 3000, "  " * 30 + "x", "\t\r\n y", "x\n", "😀😀 a",
    "same text\nsame text", "same text\nsame text", "J̌ ǰ İ ΑΣ ΟΔΟΣ.", "<|endoftext|> a<|startoftext|>b", "it's we'll '' 's 12.5", "q\x0bw\x0ce\x1fr\x85t", "long " * 40000,
    "a <|ENDOFTEXT|> b <|EndOfText|> <|STARTOFTEXT|>", "x<|endoftext|>y Upper.Lower-'S |bar| \u00c9T\u00c9 J\u030cA T\u0308 (a)b1c", "w" * 300_000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "y"), (3, "  a  b ", "z")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3)


def test_pieces_equal_library(docs):
    import sentencepiece

    blob = open(P.path("piece_bpe_32k.model"), "rb").read()
    library = sentencepiece.SentencePieceProcessor(model_proto=blob)
    rows = pt.encode_pieces(docs, P.path("piece_bpe_32k.model")).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert r.ids == library.encode(text)
        assert r.decoded == library.decode(r.ids)
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends, strict=True)) == raw
    for r in pt.piece_digests(docs, P.path("piece_bpe_32k.model")).collect():
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = library.encode(text)
        assert r.n_tokens == len(ids) and r.n_spanned == len(text.encode())
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_own_merges_equal_library():
    import sentencepiece

    blob = open(P.path("piece_bpe_32k.model"), "rb").read()
    model, library = pt.PieceModel(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    for text in ("hello", "antidisestablishmentarianism" * 3, "ééèèê", "12345"):
        assert model.own_ids(pt.SPACE + text) == library.encode(text)
    rng = np.random.default_rng(1)
    for _ in range(300):
        ids = rng.integers(0, 32000, rng.integers(0, 9))
        assert model.decode(ids) == library.decode(ids.tolist())


def _encoded(model, texts):
    """Ids and spans of each text."""
    ids, begins, ends, bounds = model.encode(pa.array(texts, pa.string()))
    return [(ids[a:b].tolist(), begins[a:b].tolist(), ends[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]


PARTS = ["a", "b", "Z", " ", "  ", "\n", "\t", "\r", "\x85", "\u3000", "É", "é", "\u0301", "ＡＢ", "ﬁ", "12", "!!", "日本", "😀", "-", " the", "①", "㌔", "ｶﾞ"]


def test_two_generations_of_chunks():
    import sentencepiece

    blob = open(P.path("piece_bpe_32k.model"), "rb").read()
    model, library = pt.PieceModel(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    model.memory.most = 500
    for text in ("a b c d", "e f g a", "h i j k l m n o p", "a b", "", "▁ ▁a ▁", " "):
        assert _encoded(model, [text])[0][0] == library.encode(text)
        assert len(model.memory.young) + len(model.memory.old) <= 20


def test_memory_does_not_grow_with_long_words():
    rng = np.random.default_rng(12)
    model = pt.PieceModel(open(P.path("piece_bpe_32k.model"), "rb").read())
    model.memory.most = 20_000
    for _ in range(20):
        texts = ["".join(rng.choice(list("abcdefgh"), 2000)) for _ in range(5)] + [" ".join("".join(rng.choice(list("abcdefgh"), 9)) for _ in range(40))]
        for text, (ids, begins, ends) in zip(texts, _encoded(model, texts), strict=True):
            assert model.library.encode(text) == ids and "".join(text[a:b] for a, b in zip(begins, ends, strict=True)) == text
        held = sum(len(k) + len(v) for m in (model.memory.young, model.memory.old) for k, v in m.items())
        assert held < 2 * 40_000


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeeze, prefix", [(False, True), (True, True), (True, False)])
def test_models_with_a_character_map_equal_library(rule, squeeze, prefix):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    rules, own = proto.ModelProto(), proto.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    own.ParseFromString(open(P.path("piece_bpe_32k.model"), "rb").read())
    own.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    own.normalizer_spec.remove_extra_whitespaces, own.normalizer_spec.add_dummy_prefix = squeeze, prefix
    model = pt.PieceModel(own.SerializeToString())
    assert model.map is not None
    rng = np.random.default_rng(13)
    texts = [None, "", " ", "ＡＢ a"] + ["".join(rng.choice(PARTS, rng.integers(0, 30))) for _ in range(150)]
    for text, (ids, begins, ends) in zip(texts, _encoded(model, texts), strict=True):
        assert ids == model.library.encode(text or "")
        assert model.decode(np.array(ids)) == model.library.decode(ids)
        assert begins == sorted(begins) and all(a <= b <= len((text or "").encode()) for a, b in zip(begins, ends, strict=True))
        # The library gives all of a character's bytes to the last of its byte pieces.
        want = [(p.begin, p.end) for p in model.library.encode(text or "", return_type="proto").pieces]
        assert all(w == (a, b) for i, w, a, b in zip(ids, want, begins, ends, strict=True) if model.spelled[i] != b"\xff" and i not in model.byte_ids)


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_compiled_map_normalises_like_library(rule):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    model = proto.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    mine = pt.PieceModel.__new__(pt.PieceModel)
    spec = model.normalizer_spec
    mine.map = pt.CharacterMap(spec.precompiled_charsmap)
    mine.prefix, mine.squeeze, mine.escape, mine.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces, False
    for text in ("ＡＢＣ  é", "ﬁne １２３ ㌔", "  lead", "tail  ", "x　y\tz\n", "①②③", "가각", "", "ｶﾞ"):
        got, places = mine.normalise(text)
        want = library.normalize(text)
        assert got == want
        assert len(places) == len(got.encode()) + 1 and (np.diff(places) >= 0).all()
        assert places[-1] <= len(text.encode())


def test_words_equal_library_and_memory_is_bounded(monkeypatch):
    from tokenizers import Tokenizer

    spec = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    words, library = ts.WordTokenizer(spec), Tokenizer.from_str(spec)
    words.memory.most = 3000
    rng = np.random.default_rng(11)
    parts = ["a", "Zb", " ", "\n", "\x85", "\u3000", "É", "e\u0301", "J\u030c", "İ", "Σ", "'s", "'", "<|", "<|endoftext|>", "<|ENDOFTEXT|>", "|>", "12", "½", "!!", "日本", "\x00", "ﬁ", "-", "The"]
    for _ in range(40):
        texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(50)] + [f"{'q' * int(n)} " for n in rng.integers(200, 400, 3)]
        for text, ids, want in zip(texts, words.encode(pa.array(texts)), library.encode_batch(texts, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
        assert all(len(k) <= 256 for k in words.memory.young) and len(words.memory.young) + len(words.memory.old) < 400


@pytest.mark.parametrize("name, change", [
    ("byte_bpe_50k.json", {}), ("word_bpe_49k.json", {"normalizer": None}), ("word_bpe_49k.json", {"pre_tokenizer": {"type": "Whitespace"}}),
    ("word_bpe_49k.json", {"added_tokens": [{"id": 0, "content": "a b", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}]}),
])
def test_other_tokenizers_are_refused(name, change):
    import json

    with pytest.raises(ValueError):
        ts.WordTokenizer(json.dumps(json.load(open(P.path(name), encoding="utf-8")) | change))


def test_token_files_round_trip(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    files = ts.write_tokens(docs, P.path("word_bpe_49k.json"), shared_dir(spark, "ids"))
    rows = sorted(ts.read_tokens(spark, files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        want = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert bytes(r.ids) == want and r.start == at and r.n_tokens == len(want) // 4
        at += r.n_tokens


def test_reader_decompresses_only_needed_frames_and_checks_them():
    stream = io.BytesIO()
    writer = ts.TokenFileWriter(stream)
    bodies = [np.arange(n, dtype="<u4").tobytes() for n in (10, 0, 200_000, 7)]
    for i, b in enumerate(bodies):
        writer.add(i if i else None, b)
    writer.close()
    raw = stream.getvalue()
    file = ts.TokenFile(pa.BufferReader(raw))
    assert [file.ids(k) for k in range(4)] == bodies and file.doc_ids == [None, 1, 2, 3]
    import zstandard

    plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(raw)
    assert plain == b"".join(bodies)
    damaged = bytearray(raw)
    damaged[40] ^= 1
    with pytest.raises(Exception):
        ts.TokenFile(pa.BufferReader(bytes(damaged))).ids(2)
    assert ts.TokenFile(pa.BufferReader(bytes(damaged))).ids(3) == bodies[3]


def test_token_files_of_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    files = ts.write_tokens(empty, P.path("word_bpe_49k.json"), shared_dir(spark, "ids"))
    assert files == [] and ts.read_tokens(spark, files).count() == 0
    assert fp.fingerprint_documents(empty).count() == 0
    assert pt.encode_pieces(empty, P.path("piece_bpe_32k.model")).count() == 0


def test_spans_and_extensions_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(40):
        a, b = ("".join(rng.choice(list("abé"), rng.integers(1, 60))) for _ in range(2))
        ha, hb = fp.PrefixHash(a), fp.PrefixHash(b)
        i, j = int(rng.integers(len(a))), int(rng.integers(len(b)))
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert ha.common_extension(i, hb, j) == n
        k = int(rng.integers(1, 10))
        assert ha.equal(i, hb, j, k) == (len(a[i : i + k]) == k == len(b[j : j + k]) and a[i : i + k] == b[j : j + k])
        if len(a) >= 4:
            assert (ha.windows(4) == ha.spans(np.arange(len(a) - 3), np.arange(4, len(a) + 1))).all()


def test_fingerprints_by_brute_force(docs):
    rows = fp.fingerprint_documents(docs).collect()
    order = sorted([(i, t or "") for i, t in enumerate(TEXTS)] + [(-1, "no id"), (3, "  a  b ")])
    want = []
    for k, (i, text) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(text) // 2
        want.append((None if i < 0 else i, len(text), text[: len(text) - half] + after[:half], after))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited) for r in rows) == sorted((-1 if w[0] is None else w[0], *w[1:3]) for w in want)
    marks = {r.edited: r.edited_fingerprint for r in rows}
    for r in rows:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.fingerprint == fp.as_text(fp.PrefixHash(text).fingerprint())
        assert r.fingerprint == marks.get(text, r.fingerprint)
        assert r.common_prefix >= len(text) - len(text) // 2 or r.common_prefix == len(r.edited)


def test_likeness_near_true_share():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(4000)]
    a = " ".join(words[:2000])
    b = " ".join(words[:1000] + words[3000:])
    spans = lambda t: {t[i : i + fp.WINDOW] for i in range(len(t) - fp.WINDOW + 1)}
    true = len(spans(a) & spans(b)) / len(spans(a) | spans(b))
    assert abs(fp.likeness(fp.PrefixHash(a).fingerprint(), fp.PrefixHash(b).fingerprint()) - true) < 0.2


def test_digest_crc(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.crc32(F.lit(b"\x01\x00\x00\x00"))).first()[0] == zlib.crc32(b"\x01\x00\x00\x00")


def test_pieces_of_long_texts_give_the_same_fingerprints(monkeypatch):
    import random

    from curatrix.llm import fingerprints as fp

    rng = random.Random(3)
    texts = ["".join(rng.choice("abé日") for _ in range(n)) for n in (70, 71, 128, 200, 333, 900)] + ["ab" * 300, "x" * 500, "short", ""]
    texts += [texts[4] + "tail", texts[5][:450] + texts[4], texts[5]]
    whole = [fp.PrefixHash(t) for t in texts]
    want = [[(a.share(b), a.common_extension(0, b, 0)) for b in whole] for a in whole]
    for piece in (50, 150):
        monkeypatch.setattr(fp, "LONG_TEXT", piece)
        again = [fp.hashed_text(t) for t in texts]
        assert sum(isinstance(h, fp.PiecewiseHash) for h in again) >= 8
        assert [h.fingerprint().tolist() for h in again] == [h.fingerprint().tolist() for h in whole]
        for a, row in zip(again, want, strict=True):
            for b, (share, common) in zip(again, row, strict=True):
                assert a.share(b) == share
                if isinstance(a, fp.PiecewiseHash):
                    assert a.common_extension(0, b, 0) == common


def test_memory_of_a_very_long_text():
    import subprocess
    import sys

    code = (
        "import resource, random; from curatrix.llm import fingerprints as fp\n"
        "text = ''.join(random.Random(1).choices('abcdefgh ', k=1_000_000)) * 8\n"
        "text = text[:7_000_000] + text[3:1_000_003]\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "a, b = fp.hashed_text(text), fp.hashed_text(text[:4_000_000] + text[5:4_000_005])\n"
        "a.fingerprint(); a.share(b)\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)"
    )
    took = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()[-1])
    assert took < 350_000
