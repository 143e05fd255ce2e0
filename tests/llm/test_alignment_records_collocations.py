"""Alignment of tokenizers, binary records and collocations against brute force."""

import bisect
import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from recprep.llm import alignment, collocations, records, vocab
from recprep.session import shared_folder
from tests.llm.conftest import by_id

JSON, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PATTERN = public_tokenizers.PATTERN
TEXTS = [
    "", " ", "  a  b", "plain words in a row, twice. plain words in a row", "x\ty\n\nz ", "日本語 テスト é́ 🙂", "a ▁ b", "<0x41> <s> </s> <unk>",
    "a <|endoftext|> b<|endoftext|>", "tail  ", "Z" * 3000 + " end", "one two　three", "\x00 \x1c q", "word " * 400,
]


def bytes_of_pieces(model):
    return [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.vocab_size())
    ]


def spans(ids, parts):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(parts[i]), i))
        at += len(parts[i])
    return out


def brute_alignment(texts):
    """Per text: (n_a, n_b, links, groups as text), by byte ranges of whole texts."""
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_parts, b_parts = vocab.token_bytes(JSON), bytes_of_pieces(model)
    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a_ids = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b_ids = model.encode(text or "")
        if not text or b"".join(a_parts[i] for i in a_ids) != whole or b"".join(b_parts[i] for i in b_ids) != whole:
            out.append((0, 0, [], ""))
            continue
        a, b = spans(a_ids, a_parts), spans(b_ids, b_parts)
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups = [([], []) for _ in ends]
        for side, tokens in enumerate((a, b)):
            for _, end, i in tokens:
                groups[bisect.bisect_left(ends, end)][side].append(str(i))
        links = [(i, j) for s, e, i in a for t, u, j in b if s < u and t < e] if len(a) < 1500 else None
        if links is None:
            links, k = [], 0
            for s, e, i in a:
                while b[k][1] <= s:
                    k += 1
                m = k
                while m < len(b) and b[m][0] < e:
                    links.append((i, b[m][2]))
                    m += 1
        out.append((len(a), len(b), links, ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)))
    return out


def wild_texts(rng, n):
    letters = "abcde ,.\n\t éß日🙂<>0"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_alignment_is_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(alignment, "_CHUNKS", 50)
    texts = TEXTS + wild_texts(random.Random(3), 150) + [None, TEXTS[3], TEXTS[3]]
    out, pairs = alignment.align(docs(list(enumerate(texts))).repartition(3), JSON, PATTERN, PIECES, keep_groups=True)
    want, found = brute_alignment(texts), by_id(
        out, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"
    )
    links = Counter(p for w in want for p in w[2])
    holders = Counter(p for w in want for p in set(w[2]))
    most = Counter()
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    assert len(found) == len(texts)
    for i, (n_a, n_b, mine, groups) in enumerate(want):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_groups = groups.count(";") + 1 if groups else 0
        best, total = sum(links[p] == most[p[1]] for p in mine), sum(links[p] for p in mine)
        assert found[i] == (n_a, n_b, n_groups, len(mine), best, total, digest, groups), repr(texts[i])[:60]
    assert {(r.a, r.b): (r.documents, r.links, r.is_best) for r in pairs.collect()} == {
        p: (holders[p], n, n == most[p[1]]) for p, n in links.items()
    }


def test_alignment_blocks_and_dense_bitmaps(spark, docs, monkeypatch):
    """Many documents with the same pairs: bitmaps of one bit per document, several slices OR-ed in a block."""
    rows = [(i, ["same words here here here", "same words", "other"][i % 3]) for i in range(9000)] + [(9000, "")]
    out, pairs = alignment.align(docs(rows).coalesce(1), JSON, PATTERN, PIECES)
    texts = [t for _, t in rows]
    want = brute_alignment(texts[:3])
    links = Counter(p for w in want for p in w[2])
    most = {b: max(n for (_, d), n in links.items() if d == b) for _, b in links}
    found = by_id(out, "n_links", "n_best", "count_sum")
    for i in range(9000):
        mine = want[i % 3][2]
        assert found[i] == (len(mine), sum(links[p] == most[p[1]] for p in mine), sum(3000 * links[p] for p in mine))
    assert found[9000] == (0, 0, 0)
    assert {(r.a, r.b): r.links for r in pairs.collect()} == {p: 3000 * n for p, n in links.items()}


def test_alignment_of_nothing(spark, docs):
    out, pairs = alignment.align(docs([]), JSON, PATTERN, PIECES)
    assert out.count() == 0 and pairs.count() == 0
    out, pairs = alignment.align(docs([(None, None), (None, "")]), JSON, PATTERN, PIECES)
    assert [tuple(r) for r in out.collect()] == [(None, 0, 0, 0, 0, 0, 0, "")] * 2 and pairs.count() == 0


def test_planes_hold_multiplicity():
    rng = np.random.default_rng(1)
    docs = np.sort(rng.integers(0, 40, 3000))
    pairs = rng.integers(0, 9, 3000)
    back = Counter()
    for plane, keys, members in alignment.planes(pairs, docs):
        for key, doc in zip(keys.tolist(), members.tolist()):
            back[key, doc] += 1 << max(0, plane - 1)
    assert back == Counter(zip(pairs.tolist(), docs.tolist()))


def test_checksums():
    assert records.crc32c([b"123456789", b"\0" * 32]).tolist() == [0xE3069283, 0x8A9136AA]
    rng = random.Random(2)
    some = [rng.randbytes(n) for n in (4, 5, 7, 511, 512, 513, 1023, 1024, 1025, 4000)]
    assert records.crc32c(some).tolist() == [records._crc32c_short(x) for x in some]
    assert records.crc32c([b"", b"abcd"]).tolist() == [0, records._crc32c_short(b"abcd")]
    assert records.crc32c([]).tolist() == []
    # The masked checksum of the framing: rotated by 15 bits, plus the constant.
    crc = int(records.crc32c([b"abcdef"])[0])
    assert int(records.masked(np.array([crc], np.uint32))[0]) == ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_frames_and_messages():
    message = records.example({"doc_id": -7, "name": b"x" * 300, "zero": 0, "big": 2**62})
    assert records.features(message) == {"doc_id": -7, "name": b"x" * 300, "zero": 0, "big": 2**62}
    framed = records.frame([message, b"abcdefgh"])
    assert records.unframe(framed) == [message, b"abcdefgh"]
    assert struct.unpack("<Q", framed[0][:8])[0] == len(message) == len(framed[0]) - 16
    for place in (0, 9, 14, len(framed[0]) - 1):
        broken = bytearray(framed[0])
        broken[place] ^= 1
        with pytest.raises(ValueError):
            records.unframe([bytes(broken)])


def test_records_are_the_tokenizer(spark, docs):
    texts = TEXTS + wild_texts(random.Random(4), 60)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(5, None), (None, "no id"), (None, ""), (14, "repeated"), (14, "repeated")]
    tokenizer = Tokenizer.from_file(JSON)  # untouched: the strings of special tokens become their ids
    out = records.binary_records(docs(rows).repartition(5), JSON, PATTERN, file_bytes=2000)
    found = sorted(out.collect(), key=lambda r: r.start)
    assert len(found) == len(rows)
    start, last = 0, -1
    seen = Counter()
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == start and r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(bytes(r.ids)) and ids[-1] == 0
        assert r.doc_id is None and last == -1 or r.doc_id >= last
        start, last = start + len(ids), -1 if r.doc_id is None else r.doc_id
        seen[r.doc_id, tuple(ids)] += 1
    want = Counter((i, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 0)) for i, t in rows)
    assert seen == want
    assert records.binary_records(docs([]), JSON, PATTERN).count() == 0


def test_records_in_shuffled_order(spark, docs):
    rows = [(i, f"text number {i}") for i in range(300)]
    folder = f"{shared_folder(spark)}/shuffled-test"
    ordered = records.ordered(docs(rows), "doc_id", "text")
    records.write_records(ordered, folder, JSON, PATTERN, end_id=0, file_bytes=1500).write.parquet(folder + "/manifest")
    manifest = records.file_starts(spark.read.parquet(folder + "/manifest"), block_parts=2)
    assert manifest.count() > 4
    one = [r.doc_id for r in records.read_records(records.shuffled(manifest, 1), folder).collect()]
    two = [r.doc_id for r in records.read_records(records.shuffled(manifest, 2), folder).collect()]
    assert sorted(one) == sorted(two) == list(range(300)) and one != two and one != sorted(one)
    straight = records.read_records(records.slices(manifest, 7), folder).orderBy("start").collect()
    assert [r.doc_id for r in straight] == list(range(300))


def test_string_ids_in_records(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "z")], "doc_id string, text string")
    out = records.binary_records(df, JSON, PATTERN).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None, "a", "b"]


def brute_collocations(rows, min_count, top, percent, max_words=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_lang = {}
    for lang, text in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append(text or "")
    out = []
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(lower)):
                words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
                n += len(words)
                for m in range(1, max_words + 1):
                    f.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        replaced = {
            p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= percent * f[p[i:j]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in replaced:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def made_rows(seed, n):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(60)] + ["The", "ÉT", "日本", "a-b", "x\x1cy"]
    weights = [1 / (1 + i) for i in range(len(words))]
    fixed = ["new york city", "the quick brown fox jumps over", "rare pair", "w1 w2 w1 w2 w1 w2"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.15 else rng.choices(words, weights)[0] for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None]), text))
    return [*rows, ("en", None), ("fr", ""), ("en", "Solo"), *rows[:20]]


@pytest.mark.parametrize(("top", "percent", "share"), [(5, 100, 0.02), (1000, 60, 0.3), (40, 100, 2.0)])
def test_collocations_are_brute_force(spark, top, percent, share):
    rows = made_rows(top, 400)
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "lang string, text string, f long, word int")
    out = collocations.collocations(df.repartition(3), min_count=6, top=top, percent=percent, first_share=share)
    assert sorted(tuple(r) for r in out.collect()) == brute_collocations(rows, 6, top, percent)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    none = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert collocations.collocations(empty).count() == 0 and collocations.collocations(none).count() == 0


def test_collocations_settle_before_frequent_words(spark, monkeypatch):
    """Words whose bound lies below the best scores are never expanded, and the result stays right."""
    rng = random.Random(9)
    rows = [("en", " ".join(f"p{k} q{k}" if rng.random() < 0.3 else f"c{rng.randrange(4)}" for k in rng.choices(range(40), k=60))) for _ in range(150)]
    expanded = []
    real = collocations.contexts
    monkeypatch.setattr(collocations, "contexts", lambda t, r, n: (expanded.append(r.count()), real(t, r, n))[1])
    df = spark.createDataFrame(rows, "lang string, text string")
    out = collocations.collocations(df, min_count=20, top=10, first_share=0.2)
    assert sorted(tuple(r) for r in out.collect()) == brute_collocations(rows, 20, 10, 100)
    words = Counter(w for _, t in rows for w in t.split())
    waves = collocations.frontier(
        spark.createDataFrame([(i, "en", w, f) for i, (w, f) in enumerate(words.items()) if f >= 20], "id long, lang string, word string, f long"),
        spark.createDataFrame([("en", sum(words.values()))], "lang string, n long"), 0.2, 4,
    )
    assert len(expanded) < waves.count()


def test_scores_pass_64_bits(spark):
    row = spark.range(1).selectExpr("4000000000000 a", "90000000000000 n", "5000000000000 l", "6000000000000 r")
    score = row.select(collocations._exact_score("a", "n", "l", "r").alias("s")).first().s
    assert score == 1000 * 4000000000000 * 90000000000000 // (5000000000000 * 6000000000000)
