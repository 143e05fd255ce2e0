"""Line deduplication, exact deduplication, SimHash, quality rules and classifier against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from pyspark.sql import functions as F

from recprep.llm import components, exact_dedup, lines, quality, queries, rules, shingles, simhash
from tests.llm.conftest import SF, by_id

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def like_lines(rows, threshold, least):
    seen, out = [], {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        removed = []
        for k, line in enumerate((text or "").lower().split("\n")):
            words = frozenset(line.split())
            if len(words) < least:
                continue
            if any(len(words & s) / len(words | s) >= threshold for s in seen):
                removed.append(k)
            seen.append(words)
        out[i] = removed
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_brute_force(docs, seed):
    rng = random.Random(seed)
    rows = []
    base = [[rng.choice(WORDS) for _ in range(rng.randint(3, 14))] for _ in range(12)]
    for i in range(40):
        text = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                line[rng.randrange(len(line))] = rng.choice(WORDS)
            text.append(" ".join(line))
        rows.append((i, "\n".join(text)))
    rows += [(100, None), (101, ""), (None, rows[0][1]), (102, " \n\n "), (103, "word " * 30000)]
    got = by_id(lines.line_dedup(docs(rows), least_words=3), "removed")
    assert got == like_lines(rows, 0.8, 3)


def test_lines_of_few_words(spark, docs, tmp_path):
    """The query and the stage remove copies of short lines and of lines without spaces too."""
    rng = random.Random(5)
    short = ["Les.", "les.", "And ornd.", "ornd. and", "a b c", "a b d", "a b c d e", "a b c d e f", "これは空白のない長い行です", "这是没有空格的一行", ""]
    rows = [(i, "\n".join(rng.choice(short) for _ in range(rng.randint(0, 5)))) for i in range(30)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = like_lines(rows, 0.8, 1)
    assert any(len(r) > 1 for r in want.values())
    assert by_id(queries.op1_line_dedup(spark, str(tmp_path)), "removed") == want
    kept = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i]) for i, t in rows}
    assert by_id(corpus_pipeline.line_stage(spark, docs(rows), str(tmp_path)), "text") == kept


def test_lines_large_similar_group_and_clean(docs):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    rows = [(i, "own line number %d is here\n" % i + " ".join(base[:20] + [f"x{rng.randrange(9)}"] + base[20:])) for i in range(120)]
    rows = rows + rows[:2]
    got = lines.clean(docs(rows), threshold=0.9, least_words=3)
    assert got.columns == docs([]).columns and got.count() == len(rows)
    kept = by_id(got, "text")
    assert kept[0] == rows[0][1] and all(kept[i] == rows[i][1].split("\n")[0] for i in range(1, 120))
    assert lines.line_dedup(docs([])).count() == 0


@pytest.mark.parametrize("limits", [{"_HOT": 3}, {"_KEPT": 2, "_BEST": 1}, {"_KEPT": 9, "_BEST": 1}])
def test_lines_with_many_candidates_and_hot_words(docs, monkeypatch, limits):
    """Lines whose first candidates are not like them, and words of many lines, are asked for again."""
    for name, value in limits.items():
        monkeypatch.setattr(lines, name, value)
    monkeypatch.setattr(lines, "_AT_ONCE", 50)
    rng = random.Random(7)
    base = [rng.sample(WORDS, 12) for _ in range(3)] + [[f"long{i}" for i in range(150)]]
    rows = []
    for i in range(60):
        line = list(rng.choice(base))
        for _ in range(rng.randint(0, 3) if len(line) < 100 else rng.randint(10, 40)):
            line[rng.randrange(len(line))] = rng.choice(WORDS)
        rows.append((i, " ".join(line) + "\n" + " ".join(rng.choice(base))))
    assert by_id(lines.line_dedup(docs(rows)), "removed") == like_lines(rows, 0.8, 1)


def test_line_postings_are_shuffled_in_few_rows_and_texts_once(spark, docs, tmp_path):
    """A row of the shuffle holds the postings of many lines; texts beside their line numbers go through one exchange."""
    rows = [(i, "\n".join(f"some words of line {i} {k} {k % 7} and more" for k in range(20))) for i in range(50)]
    texts = lines._docs(docs(rows), "doc_id", "text")
    weights = spark.sparkContext.broadcast(np.full(lines._SKETCH, 9, np.uint8))
    assert lines.postings(texts, 0.8, 1, weights, 3).count() <= 3 * texts.rdd.getNumPartitions()
    marks = texts.select("doc", "h", F.lit(3).cast("long").alias("line"))
    bits = spark.sparkContext.broadcast(lines._doc_filter(marks))
    met = lines._with_lines(texts, marks.limit(20), bits, {"only": F.col("line")}, "left")
    assert met.count() == 50 and met.filter("only IS NOT NULL").count() == 20
    shuffled = [x for x in met._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x and "REPARTITION" in x]
    assert len(shuffled) == 1 and "SortMergeJoin" not in met._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("files", [None, 1])
def test_exact_dedup(spark, written, files):
    rows = [(5, "a  b"), (3, "a\t\nb"), (9, "c"), (7, None), (8, ""), (None, "c"), (2, "c d"), (4, " a b"), (4, " a b"), (11, "x" * 200_000)]
    got = exact_dedup.exact_dedup(spark, written(rows, 4), max_files_per_trigger=files).collect()
    groups = Counter()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first = {}
    for i, t in rows:
        groups[norm(t)] += 1
        if i is not None:
            first[norm(t)] = min(i, first.get(norm(t), i))
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(
        (i or -1, first[norm(t)], groups[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows
    )
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_checks_full_bytes(spark, written):
    """With digests of one byte most hits are false ones."""
    rows = [(i, f"text {i % 300}") for i in range(900)]
    got = by_id(exact_dedup.exact_dedup(spark, written(rows, 3), digest_bytes=1, max_files_per_trigger=1), "keep_id", "group_size", "kept")
    assert got == {i: (i % 300, 3, i < 300) for i in range(900)}


def test_exact_dedup_state_goes_on(spark, written, docs, tmp_path):
    folder, state = written([(i, f"t{i}") for i in range(20)], 2), str(tmp_path / "state")
    exact_dedup.update_state(spark, folder, state)
    docs([(i, f"t{i % 25}") for i in range(20, 50)]).write.mode("append").parquet(folder)
    got = by_id(exact_dedup.exact_dedup(spark, folder, checkpoint=state), "keep_id", "group_size")
    assert got == {i: (i % 25, 2) for i in range(50)}
    assert exact_dedup.exact_dedup(spark, written([])).count() == 0


def brute_fingerprint(text, words):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    root = {i: i for i in nodes}
    find = lambda i: i if root[i] == i else find(root[i])
    for i in nodes:
        for j in nodes:
            if j < i and near(i, j) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in nodes}


def test_simhash_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    texts = by_id(df, "text")
    fps = {i: brute_fingerprint(t, 4) for i, t in texts.items()}
    want = brute_components(sorted(fps), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 4)
    got = by_id(simhash.near_duplicates(df), "fp", "component_id")
    assert {i: (f & (2**64 - 1), c) for i, (f, c) in got.items()} == {i: (fps[i], want[i]) for i in fps}


@pytest.mark.parametrize("variants", [1 << 9, 1 << 14, 1 << 21])
def test_simhash_links(spark, variants):
    rng = random.Random(variants)
    fps = [rng.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1, 2**63]
    for _ in range(160):  # chains and dense balls
        x = rng.choice(fps)
        for _ in range(rng.randint(1, 6)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 4, bucket_variants=variants)
    for a, b in edges.collect():
        assert bin((a ^ b) & (2**64 - 1)).count("1") > 0
    roots = {r.node: r.root for r in components.connected_components(edges).collect()}
    got = {x: roots.get(s[0], s[0]) & (2**64 - 1) for x, s in zip(fps, signed)}
    want = brute_components(fps, lambda a, b: bin(a ^ b).count("1") <= 4)
    assert len(set(zip(got.values(), want.values()))) == len(set(got.values())) == len(set(want.values()))


def test_simhash_cases(docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (6, "other words here now"), (None, "one two"), (6, "other words here now")]
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(docs(rows)).collect())
    assert got == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (6, 6), (-1, 4)])
    assert simhash.near_duplicates(docs([])).count() == 0


def near_groups(rows, words=5, threshold=0.8):
    """The id that is kept of each group, by brute force."""
    sets = {}
    for i, t in rows:
        parts = (t or "").lower().split()
        sets[i] = {tuple(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))} if parts else set()

    def near(a, b):
        return sets[a] == sets[b] or len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9

    names = brute_components(list(sets), near)
    return sorted(set(names.values()))


def test_near_duplicate_stage_finds_all_pairs(spark, docs):
    rng = random.Random(7)
    rows = []
    for i in range(0, 120, 4):
        base = [rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(rng.randint(30, 120))]
        rows.append((i, " ".join(base)))
        for k in (1, 2, 3):
            copy = list(base)
            for _ in range(rng.randint(1, 4)):
                copy[rng.randrange(len(copy))] = "new"
            rows.append((i + k, " ".join(copy)))
    rows += [(200, "a b"), (201, "A  b"), (202, "a b c"), (203, None), (204, " "), (205, "a b c d e"), (206, "a b c d e f")]
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs(rows), SF).collect())
    assert got == near_groups(rows)


def test_near_duplicate_stage_links_near_fingerprints(spark, docs, monkeypatch):
    base = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, *[f"e{j}" for j in range(4)]])), (3, " ".join(f"v{i}" for i in range(400))), (4, None), (5, " ")]
    near, seen = shingles.simhash.links, []
    monkeypatch.setattr(shingles.simhash, "links", lambda nodes, radius: (seen.append((nodes.count(), radius)), near(nodes, radius))[1])
    none = spark.createDataFrame([], "shingle long, key long, n int, place int")
    monkeypatch.setattr(shingles, "postings", lambda *_: none)  # the fingerprints alone
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs(rows), SF).collect())
    assert got == [1, 3, 4] and seen == [(3, 4)]


def test_near_duplicate_cases(docs):
    base = [f"w{i}" for i in range(60)]
    group = [(i, " ".join([*base, f"x{i}"])) for i in range(150)]
    rows = [*group, (3, group[3][1]), (None, "one two three four five six"), (None, "one two three four five six")]
    mine = docs(rows).withColumns({"row_hash": F.lit("mine"), "chosen_h": F.lit("own"), "root": F.lit(1.5)})
    held = shingles.keep_one(mine)
    assert held.schema == mine.schema and {(r.row_hash, r.chosen_h, r.root) for r in held.collect()} == {("mine", "own", 1.5)}
    kept = shingles.keep_one(docs(rows))
    assert kept.columns == docs([]).columns and sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 0]
    assert shingles.keep_one(docs([])).count() == 0


def test_rule_signals(spark, docs):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    more = docs([(-1, None), (-2, ""), (-3, "a b c d e f g h " * 3000), (-4, " x\n\nx\n x")]).select("doc_id", "text")
    both = df.unionByName(more)
    got = by_id(rules.quality_rules(both), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for i, text in by_id(both, "text").items():
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        often = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
        full = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(covered))
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        assert got[i][:6] == (*want, failed) and not (failed and got[i][6])
    assert rules.quality_rules(docs([])).count() == 0


def test_rule_model_is_em(spark):
    """The learned model is a fixed point of plain expectation-maximisation on the same votes."""
    rng = np.random.default_rng(1)
    table = Counter()
    for _ in range(4000):
        good = rng.random() < 0.8
        vote = sum(int(rng.choice(3, p=(0.02, 0.78, 0.2) if good else (0.5, 0.3, 0.2))) * 3**i for i in range(4))
        table[vote] += 1
    model = rules.learn(spark.createDataFrame(list(table.items()), "vote long, n long"), 4, steps=60)
    votes = np.array(list(table)), np.array(list(table.values()))
    odds = np.full(len(votes[0]), model.prior_odds())
    for i in range(4):
        odds += np.array(model.odds())[3 * i + votes[0] // 3**i % 3]
    p = 1 / (1 + np.exp(-odds))
    n = votes[1].sum()
    assert abs(((p * votes[1]).sum() + n * 0.85) / (2 * n) - model.prior) < 1e-3
    assert all(g[0] < b[0] for g, b in zip(model.given_good, model.given_bad))


def test_quality_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    df, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(df, labels)
    scores = by_id(quality.score(df, model), "score")
    import zlib

    held = [(scores[r.doc_id], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.95 and np.mean([(s >= 0.5) == q for s, q in held]) > 0.95


def test_quality_sample_keeps_the_class_share(spark, docs, monkeypatch):
    """Where the sample is bounded, the bias still has the odds of the labels of all rows."""
    rng, fitted, plain = random.Random(9), [], quality._logistic
    monkeypatch.setattr(quality, "_logistic", lambda x, y: fitted.append((plain(x, y), y)) or fitted[-1][0])
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(12))) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i, _ in rows], "doc_id long, quality int")
    used = [int(i % 10 > 0) for i, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    for bound in (3000, 20):
        bias = quality.fit(docs(rows), labels, sample_rows=bound).weights[0]
        weights, y = fitted[-1]
        assert len(y) == min(bound, sum(used)) + min(bound, len(used) - sum(used))
        missing = np.log(sum(used) / (len(used) - sum(used))) - np.log(sum(y) / (len(y) - sum(y)))
        assert bias - weights[0] == pytest.approx(missing) and (missing > 1 if bound == 20 else missing == pytest.approx(0))


def test_quality_cases(spark, docs):
    df = docs([(1, None), (2, ""), (3, "word " * 100_000), (3, "word " * 100_000), (None, "x")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, labels)
    assert model.weights == () and {r.score for r in quality.score(df, model).collect()} == {0.5}
    assert quality.score(docs([]), model).count() == 0
    assert quality.fit(docs([]), labels.limit(0)).weights == ()
    assert quality.score(df, model, name="n").columns[-1] == "n"
