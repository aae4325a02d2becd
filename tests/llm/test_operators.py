"""Small tables against the definitions: nulls, empty and long texts, ties, repeated rows, other columns."""

import base64
import hashlib
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from closepass.llm import (
    chat,
    components,
    decontamination,
    languages,
    near_duplicates,
    neighbours,
    packing,
    repeated_spans,
    secrets,
    suffix_sort,
    token_files,
    tokens,
    toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key long"


def documents(spark, texts, langs=None):
    langs = langs or ["en"] * len(texts)
    rows = [(i, t, la, "s", len(t or ""), 0.5, 7) for i, (t, la) in enumerate(zip(texts, langs))]
    return spark.createDataFrame(rows, DOCS)


def words(seed, n, size=400):
    random = np.random.default_rng(seed)
    return [f"w{k}" for k in random.integers(0, size, n)]


@pytest.fixture(scope="module")
def odd_texts():
    base = words(1, 300, 5000)
    near = base[:150] + ["changed"] + base[151:]
    other = base[:100] + words(2, 200, 5000)
    return [None, "", " .,!", "one two", "One, TWO!", " ".join(base), " ".join(near), " ".join(other), " ".join(base), "é中😀 x"]


def test_suffix_sort_is_byte_order():
    random = np.random.default_rng(3)
    strings = [bytes(random.integers(97, 99, random.integers(0, 70)).astype(np.uint8)) for _ in range(800)]
    strings += [b"a" * 100 + s for s in strings[:300]] + strings[:50]
    order, lcp = suffix_sort.ranked(strings)
    assert [strings[i] for i in order] == sorted(strings)
    assert all(lcp[k] == suffix_sort.common_prefix(strings[order[k - 1]], strings[order[k]]) for k in range(1, len(order)))
    assert suffix_sort.common_prefix(b"abcd", b"abx") == 2 and suffix_sort.common_prefix(b"", b"a") == 0


def test_repeated_spans_match_brute_force(spark, odd_texts):
    passage, line = " ".join(words(5, 200)), "x" * 1500
    texts = [*odd_texts, passage, f"before {passage[:450]} after", f"{passage[30:600]} é {passage[:399]}", line, "ab" * 500, "é" * 210]
    got = repeated_spans.without_repeats(documents(spark, texts)).orderBy("doc_id").collect()
    want = repeated_spans.brute_force(texts)
    assert [(r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got] == want


def test_large_groups_are_split_alike(spark, monkeypatch):
    shared = "".join(map(chr, np.random.default_rng(9).integers(97, 123, 420)))
    texts = [f"{'pqr'[i % 3] * 30}{i:03d}{shared}{i % 7}{'z' * 40}{i:03d}" for i in range(60)]
    monkeypatch.setattr(repeated_spans, "BUCKET_ROWS", 10)
    got = repeated_spans.without_repeats(documents(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got] == repeated_spans.brute_force(texts)


def test_no_sort_takes_a_large_group(spark, monkeypatch):
    random = np.random.default_rng(10)
    shared, line = ("".join(map(chr, random.integers(97, 123, n))) for n in (390, 700))
    parts = ["".join(map(chr, random.integers(97, 123, 300))) for _ in range(90)]
    texts = [f"{a}{shared if i % 3 else line}{parts[i // 2]}" for i, a in enumerate(parts)]
    texts += [f"{parts[5]}{shared}{'é' * 150}", line + shared, None]
    sort = repeated_spans._sort_bucket

    def checked(table):
        groups = table["grp"].to_pylist()
        if max(map(groups.count, groups)) > 10:
            raise ValueError("a large group in one sort")
        return sort(table)

    monkeypatch.setattr(repeated_spans, "BUCKET_ROWS", 10)
    monkeypatch.setattr(repeated_spans, "_sort_bucket", checked)
    got = repeated_spans.without_repeats(documents(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got] == repeated_spans.brute_force(texts)


def test_alignment():
    a = np.arange(100, dtype=np.uint64)
    assert near_duplicates.alignment(a, a, 0.8) == 1
    b = np.delete(a, [10, 50, 51])
    assert near_duplicates.alignment(a, b, 0.8) == pytest.approx(97 / 100)
    assert near_duplicates.alignment(a, a[::-1].copy(), 0.8) == 0
    c = a.copy()
    c[20:32] += np.uint64(1000)
    assert near_duplicates.alignment(a, c, 0.8) == 0  # 88 of 112
    assert near_duplicates.alignment(a, c, 0.78) == pytest.approx(88 / 112)


def test_near_duplicates(spark, odd_texts):
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(documents(spark, odd_texts)).collect()}
    assert len(got) == len(odd_texts)
    classes = {d: r.class_id for d, r in got.items()}
    assert classes[0] == classes[1] == classes[2] == 0  # without words
    assert classes[3] == classes[4] == 3
    assert classes[5] == classes[6] == classes[8] == 5 and got[8].text_id == 5
    assert classes[7] == 7 and classes[9] == 9


def test_near_duplicates_without_doc_id(spark):
    base, other = (" ".join(words(k, 200, 5000)) for k in (11, 12))
    rows = [(5, base), (None, base), (7, base), (6, base + " more"), (None, other), (None, other), (None, other + " more"), (9, "lone"), (None, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, 7) for i, t in rows], DOCS)
    got = near_duplicates.near_duplicates(docs).collect()
    assert sorted(r[1:] for r in got if r.doc_id is not None) == [(5, 5), (5, 5), (6, 5), (8, 8), (9, 9)]
    without = sorted(r[1:] for r in got if r.doc_id is None)
    assert without[:2] == [(5, 5), (8, 8)] and len({r[1] for r in without[2:]}) == 1 and without[2][1] >= 1 << 62
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(kept) == 4 and {(5, base), (8, ""), (9, "lone")} < {*kept}
    assert {*kept} & {(None, other), (None, other + " more")}


def test_short_near_duplicates_are_all_found(spark):
    random = np.random.default_rng(13)
    texts = []
    for k in range(60):
        base = [f"s{k}x{i}" for i in range(8 + k % 5)]
        # a word at either end adds a shingle and changes none
        texts += [" ".join(base), " ".join([*base, "end"] if random.random() < 0.5 else ["begin", *base])]
    texts += ["a b c d e e e e e e", "a b c d e e e e e e e"]
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(documents(spark, texts), sketches=1).collect()}
    assert all(got[i] == i // 2 * 2 for i in got) and len(got) == len(texts)
    assert near_duplicates.one_apart(0.8) == 9 and near_duplicates.one_apart(1.0) == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 130)] + [(200, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{k: 100 for k in range(100, 130)}}


def test_decontamination(spark):
    item = " ".join(f"q{i}" for i in range(12))
    items = spark.createDataFrame([(1, item), (2, "tiny item"), (3, None), (10, item), (4, "...")], "item_id long, text string")
    texts = [None, "", f"a b {item.upper()} c", " ".join(item.split()[1:11]) + " x", item[:26], "so tiny, ITEM tiny item", f"a b {item.upper()} c"]
    got = {r.doc_id: r for r in decontamination.contamination(documents(spark, texts), items).collect()}
    assert [got[i].n_hit for i in range(7)] == [0, 0, 12, 10, 0, 4, 12]
    assert got[2].item_ids == ["1", "10"] == got[3].item_ids and got[5].item_ids == ["2"] and got[2].n_words == 15
    none = decontamination.contamination(documents(spark, texts), items.limit(0)).collect()
    assert sum(r.n_hit for r in none) == 0 and len(none) == 7


def test_secrets():
    def der(tag, body):
        size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
        return bytes([tag]) + size + body

    numbers = b"".join(der(2, bytes([1 + k]) * 64) for k in range(8))
    rsa = der(0x30, der(2, b"\0") + numbers)
    ssh = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", b"k" * 32))
    part = lambda o: base64.urlsafe_b64encode(json.dumps(o).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'HS256'})}.{part({'sub': 'me'})}.c2ln"
    b64 = base64.b64encode(rsa).decode()
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(b64[i : i + 64] for i in range(0, len(b64), 64)) + "\n-----END RSA PRIVATE KEY-----"
    assert secrets.spans(f"é {pem} .") == [(2, 2 + len(pem), "der")]
    assert secrets.spans(b64) == [(0, len(b64), "der")]
    assert ("der" in [k for *_, k in secrets.spans(rsa.hex())]) and secrets.is_der_key(rsa) and not secrets.is_der_key(rsa[:-1])
    key = base64.b64encode(ssh).decode()
    assert secrets.spans(f"ssh-ed25519 {key} me") == [(12, 12 + len(key), "ssh")]
    assert secrets.spans(f"see {jwt}.") == [(4, 4 + len(jwt), "jwt")]
    assert secrets.spans(f"see {jwt[1:]}") == [] and secrets.spans(base64.b64encode(bytes(range(200))).decode()) == []
    assert secrets.spans("Token=abc1234 token: 'abcd1234'") == [(14, 30, "assign")]
    assert secrets.spans("AKIA" + "A" * 11 + " AKIA" + "B" * 12) == [(16, 32, "access")]
    assert secrets.spans("0" * 31 + " " + "f" * 32) == [(32, 64, "hex")]
    assert secrets.masked("a token = 0123456789abcdef0123456789abcdef b") == "a [SECRET] b"


def _der(tag, body):
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


def _wrapped(text, width, between):
    return between.join(text[i : i + width] for i in range(0, len(text), width))


@pytest.mark.parametrize("last", [62, 63, 64])
@pytest.mark.parametrize("between", ["\n", "\r\n", "\n\t  ", "\\n", "\\r\\n", "\\\\n", '\\n"\n  "', '\\n" +\n  "'])
def test_keys_over_several_lines(last, between):
    numbers = [bytes([1 + k]) * 64 for k in range(7)] + [b"\7" * last]
    rsa = _der(0x30, _der(2, b"\0") + b"".join(_der(2, x) for x in numbers))
    ssh = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-rsa", b"\1\0\1", b"k" * (last + 200)))
    for key, kind in ((rsa, "der"), (ssh, "ssh")):
        b64 = base64.b64encode(key).decode()
        for width in (64, 76, 61):
            body = _wrapped(b64, width, between)
            assert secrets.spans(body) == [(0, len(body), kind)]
            assert secrets.spans(f"the key is{between}{body}{between}and more") == [
                (10 + len(between), 10 + len(between) + len(body), kind)
            ]
            begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
            for pem in (f"{begin}{between}{body}{between}{end}", f"{begin}{between}{body}", f"{body}{between}{end}"):
                assert secrets.spans(f'"k": "{pem}", x') == [(6, 6 + len(pem), kind)]
            assert secrets.masked(f"a {body}, b") == "a [SECRET], b"
        body = _wrapped(key.hex(), 64, between)
        assert (0, len(body), kind) in secrets.spans(body)
        assert not {"der", "ssh"} & {k for *_, k in secrets.spans(_wrapped(b64[:-8], 64, between))}
    two = _wrapped(b64.rstrip("="), 64, between) + between + _wrapped(b64, 64, between)
    assert [k for *_, k in secrets.spans(two)] == ["ssh", "ssh"]


def test_keys_of_any_algorithm_and_tokens_of_any_header():
    def algorithm(oid, *more):
        return _der(0x30, _der(6, bytes.fromhex(oid)) + b"".join(more))

    version, key, salt = _der(2, b"\0"), b"\5" * 56, _der(4, b"salt" * 2)
    keys = [
        _der(0x30, version + algorithm("2b656e") + _der(4, _der(4, key[:32]))),  # X25519
        _der(0x30, version + algorithm("2b656f") + _der(4, _der(4, key))),  # X448
        _der(0x30, version + algorithm("2b6571") + _der(4, _der(4, key))),  # Ed448
        _der(0x30, version + algorithm("2a864886f70d01010a") + _der(4, _der(0x30, version * 30))),  # RSA-PSS
        _der(0x30, version + algorithm("2a864886f70d010301", _der(0x30, version * 2)) + _der(4, _der(2, key))),  # DH
        _der(0x30, algorithm("2b6571") + _der(3, b"\0" + key)),
        _der(0x30, algorithm("2a864886f70d010c0103", _der(0x30, salt + _der(2, b"\1"))) + _der(4, key)),  # PKCS#12
    ]
    for k in keys:
        b64 = base64.b64encode(k).decode()
        assert secrets.spans(f"key: {b64}") == [(5, 5 + len(b64), "der")]
    digest = _der(0x30, algorithm("608648016503040201", _der(5, b"")) + _der(4, key[:32]))
    opaque = _der(0x30, version + algorithm("2b6571") + _der(4, key))
    assert not secrets.is_der_key(digest) and not secrets.is_der_key(opaque)
    part = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    for head in (b'{"alg":"none"}', b'{ "alg": "ES256" }', b'{\n  "alg": "RS256"}', b'\r\n{"alg":"RS256"}', b' {"alg":"RS256"}', b'\t{"alg":"RS256"}'):
        token = f"{part(head)}.{part(b'any bytes')}.c2ln"
        assert secrets.spans(f"a.{token} b") == [(2, 2 + len(token), "jwt")]
    assert secrets.spans(f"{part(b'{}          ')}.c2ln.c2ln") == [] == secrets.spans("Domains.example.com")


def test_secret_rows(spark):
    docs = documents(spark, [None, "", "password=hunter22x y"])
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert got[0].spans == got[1].spans == "" and got[2].spans == "assign:0:18" and got[2].n_assign == 1
    kept = {r.doc_id: r for r in secrets.without_secrets(docs).collect()}
    assert kept[2].text == "[SECRET] y" and kept[2].n_chars == 10 and kept[0].text is None and kept[0].n_chars == 0


def test_pieces_are_the_tokenizers(spark):
    encoder = tokens.Encoder(tokens.default_path())
    random = np.random.default_rng(4)
    parts = ["'s", "'re", "'", "s", " ", "  ", "\n", "\t", "a", "B9", "é", "½", "!?", "_", "中", "😀", "\u0085", "<|endoftext|>"]
    texts = [None, ""] + ["".join(random.choice(parts, random.integers(0, 25))) for _ in range(3000)]
    import pyarrow as pa

    got = []
    for _, ids, bounds in encoder.column(pa.array(texts), 2):
        got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    want = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert got == [[*e.ids, 2] for e in want]


def test_added_tokens_are_the_librarys(spark, tmp_path):
    import pyarrow as pa
    from tokenizers import AddedToken, Tokenizer

    mark = "<|endoftext|>"
    texts = ["plain", f"a{mark}b", mark, "<|endof", "text|> c", f"{mark}{mark} é {mark}", None, f"x {mark}", "more of the text", "中" + mark]

    def ids_of(path):
        found = []
        for _, ids, bounds in tokens.Encoder(path).column(pa.array(texts), 2):
            found += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        return found

    def library(path):
        fresh = Tokenizer.from_file(path)
        return [[*fresh.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]

    path = tokens.default_path()
    assert ids_of(path) == library(path) and ids_of(path)[1] == [64, 50256, 65, 2]
    files = token_files.write_token_files(documents(spark, texts), path, 2)
    assert [r.ids for r in sorted(token_files.read_token_files(files).collect())] == library(path)
    other = Tokenizer.from_file(path)
    other.add_tokens([AddedToken(" of the", normalized=False), AddedToken("ore", single_word=True)])
    other.save(str(tmp_path / "other.json"))
    assert ids_of(str(tmp_path / "other.json")) == library(str(tmp_path / "other.json"))


def test_a_worker_encodes_a_piece_once_for_all_its_tasks(monkeypatch):
    import pyarrow as pa
    import pyspark

    sent = []
    encode = tokens.Encoder._encode_pieces
    monkeypatch.setattr(
        tokens.Encoder, "_encode_pieces", lambda self, pieces, joins: sent.extend(pieces) or encode(self, pieces, joins)
    )
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["ozzle wuzzle 1", "wuzzle, ozzle"]})
    tasks = [list(token_files._write(tokens.default_path(), 2)(iter([batch]))) for _ in range(3)]
    assert tasks[0] == tasks[1] == tasks[2] and sent.count(" wuzzle") == sent.count(" ozzle") == 1


def test_pieces_known_and_forgotten(monkeypatch):
    import pyarrow as pa

    encoder = tokens.Encoder(tokens.default_path())
    low = np.arange(1, 40_001, dtype=np.uint64) << np.uint64(40)  # all begin at one slot of a small table
    hashes = np.concatenate([low[:300], np.random.default_rng(9).integers(1, 1 << 63, 40_000).astype(np.uint64)])
    assert (encoder._find(hashes) == -1).all()
    for at in range(0, len(hashes), 8060):  # grows while it is filled
        part = hashes[at : at + 8060]
        encoder._add(part, np.arange(2 * len(part), dtype=np.int32), np.full(len(part), 2))
    assert (encoder._find(hashes) == np.arange(len(hashes))).all()
    assert (encoder._find(low[300:]) == -1).all() and (np.diff(encoder.start[: encoder.pieces]) == 2).all()

    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 400)
    encoder._clear()
    texts = [" ".join(words(k, 60)) + f" x{k}, été!  \n{k}" for k in range(40)]
    found = []
    for _, ids, bounds in encoder.column(pa.array(texts), 2):
        found += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert found == [[*e.ids, 2] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_images_round_trip():
    random = np.random.default_rng(6)
    for n in (0, 1, 127, 128, 1000):
        ids = np.where(random.random(n) < 0.05, random.integers(0, 1 << 31, n), random.integers(50, 90, n)).astype(np.int32)
        ends = np.sort(random.integers(0, n + 1, 5))
        ends[-1] = n
        doc_ids, got_ends, got = token_files.read_image(token_files.write_image(np.arange(5), ends, ids))
        assert (got == ids).all() and (got_ends == ends).all() and doc_ids.tolist() == list(range(5))


def test_token_files(spark, odd_texts):
    docs = documents(spark, odd_texts)
    encoder = tokens.Encoder(tokens.default_path())
    want, start = [], 0
    for i, t in enumerate(odd_texts):
        ids = [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    files = token_files.write_token_files(docs, tokens.default_path(), 2)
    assert sorted(map(tuple, token_files.read_token_files(files).collect())) == want
    assert token_files.write_token_files(docs.limit(0), tokens.default_path(), 2).count() == 0


def test_packing(spark, odd_texts):
    texts = [*odd_texts, " ".join(words(8, 3000))]
    pieces = packing.packed(documents(spark, texts), tokens.default_path(), size=256)
    rows = pieces.orderBy("doc_id", "piece").collect()
    whole = {}
    for r in rows:
        assert r.start == len(whole.setdefault(r.doc_id, b"")) // 4 and len(r.ids) == 4 * r.length
        whole[r.doc_id] += bytes(r.ids)
    encoder = tokens.Encoder(tokens.default_path())
    for i, t in enumerate(texts):
        ids = [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert whole[i] == np.array(ids, "<u4").tobytes()
    total = sum(r.length for r in rows)
    packed = packing.sequences(pieces).collect()
    assert sum(len(r.ids) for r in packed) == 4 * total and max(len(r.ids) for r in packed) <= 1024
    assert packing.packed(documents(spark, texts).limit(0), tokens.default_path()).count() == 0


def test_plan_replaces_the_smallest_by_two():
    counts = np.zeros(11, dtype=np.int64)
    counts[[6, 3, 2]] = 1, 1, 1  # 6 + 3 leaves a gap of one, and 2 + 2 is not there
    assert packing.plan(counts, 10)[0] == ([6, 3], 1)
    counts = np.zeros(21, dtype=np.int64)
    counts[[12, 7, 5, 3]] = 1, 1, 1, 1
    assert packing.plan(counts, 20)[0] == ([12, 5, 3], 1)
    counts = np.zeros(11, dtype=np.int64)
    counts[[7, 3]] = 5, 2
    assert sum(n for _, n in packing.plan(counts, 10)) == 5


def test_chat_round_trip(spark):
    text = "a\\<|end|>\\\\<|next|> <"
    rows = [
        (1, 0, "user", text), (1, 1, "user", None), (1, 2, "assistant", text), (1, 3, "assistant", "b"), (1, 3, "assistant", "b"),
        (2, None, None, "<|role|>"), (2, 0, "assistant", "<"), (3, 0, "system", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {
        r.conv_id: r
        for r in chat.formatted(frame)
        .select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss")).alias("loss"))
        .collect()
    }
    assert [tuple(t) for t in got[1].turns] == [("user", text), ("user", ""), ("assistant", text), ("assistant", "b"), ("assistant", "b")]
    assert got[1].loss == text + "bb" and got[1].formatted.count(chat.ROLE) == 2
    assert [tuple(t) for t in got[2].turns] == [("", "<|role|>"), ("assistant", "<")] and got[2].loss == "<" and got[3].loss == ""


def test_neighbours(spark):
    random = np.random.default_rng(2)
    vectors = random.normal(size=(600, 8)).round(3).tolist()
    vectors[5:40] = [vectors[5]] * 35
    rows = [(i, v, "x") for i, v in enumerate(vectors)]
    rows += [(900, None, "x"), (1000, [0.0] * 8, "x"), (1100, [float("nan")] * 8, "x"), (1200, [None] * 8, "x"), (1300, [1.0], "x"), (0, vectors[0], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")
    got = neighbours.nearest(frame, F.col("vec_id") % 100 == 0).toPandas()
    x, met = np.array(vectors), []
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(600), d)) if i != q][:10]
        met.append(len({*best} & {*g.vec_id}) / 10)
        assert g.sort_values("rank")["rank"].tolist() == list(range(1, 11)) and np.allclose(g.score, d[g.vec_id])
    assert sorted(got.query_id.unique()) == [0, 100, 200, 300, 400, 500] and np.mean(met) >= 0.9
    few = neighbours.nearest(frame.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [r.rank for r in few] == [1, 2] and neighbours.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0


def test_languages(spark):
    random = np.random.default_rng(7)
    kinds = {"aa": ["tok", "mira", "sel"], "bb": ["ghu", "yzw", "quo"]}
    make = lambda k, n: " ".join("".join(random.choice(kinds[k], 3)) for _ in range(n))
    texts = [make(k, 40) for k in ("aa", "bb") * 30]
    model = languages.fit(documents(spark, texts, ["aa", "bb"] * 30))
    probe = [None, "", "12 34 .", make("aa", 30), make("bb", 3), make("aa", 30) + " " + make("bb", 90)]
    got = {r.doc_id: r for r in languages.identify(documents(spark, probe), model).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["und", "und", "und", "aa", "bb", "bb"]
    mixed = {m.lang: m.share for m in got[5].mixture}
    assert mixed["aa"] == pytest.approx(0.25, abs=0.05) and got[3].mixture[0].share == 1 and got[0].score == 0
    none = languages.fit(documents(spark, texts).limit(0))
    assert {r.lang_pred for r in languages.identify(documents(spark, probe), none).collect()} == {"und"}


def test_toxicity(spark):
    texts = [" ".join(words(k, 30, 3000) + (["nasty", "words"] if k % 2 else [])) for k in range(1000)]
    docs = documents(spark, texts)
    rows = docs.select("doc_id", "text", "lang", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    classifier = toxicity.fit(rows.where("doc_id < 800"))
    got = [r.predicted for r in toxicity.scored(docs, classifier).orderBy("doc_id").collect()]
    assert np.mean([g == k % 2 for k, g in enumerate(got)][800:]) > 0.9
    empty = toxicity.scored(documents(spark, [None, "", "..."]), classifier).collect()
    assert len({r.score for r in empty}) == 1 and 0 <= empty[0].score <= 1
    assert toxicity.without_toxic(docs, classifier).columns == docs.columns
    unfit = toxicity.fit(rows.where("toxic = 0"))
    assert {r.score for r in toxicity.scored(docs, unfit).collect()} == {0.0}


def test_rare_languages_are_calibrated(spark):
    texts, langs = [], []
    for k in range(2400):
        rare = k % 24 in (0, 1)
        texts.append(" ".join([("ru" if rare else "co") + w for w in words(k, 20, 60)] + (["nasty"] if k % 2 else [])))
        langs.append("rr" if rare else "cc")
    rows = documents(spark, texts, langs).select("doc_id", "text", "lang", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    classifier = toxicity.fit(rows, 300)
    assert sorted(classifier.languages.languages) == ["cc", "rr"] and classifier.calibrated.all()
    few = toxicity.fit(rows.where("lang = 'cc' or doc_id < 400"), 300)
    assert dict(zip(few.languages.languages, few.calibrated.tolist())) == {"cc": True, "rr": False}
