"""The corpus operators against brute force, on small tables with every awkward case."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import (
    byte_pairs, common, decontamination, fingerprints, line_dedup, line_quality, personal_data, secrets,
    shingle_join, substring_dedup, toxicity,
)
from tests.conftest import TEST_FOLDER

BASE = " ".join(f"w{k}" for k in range(60))
LONG = " ".join(f"x{k % 997}y{k % 31}" for k in range(30_000))
NEAR = BASE.replace("w30 ", "changed ")
LEAK = " ".join(f"item{k}" for k in range(20))
AWKWARD = [
    (1, BASE), (2, BASE), (3, NEAR), (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "One two\nthree"),
    (9, LONG), (10, LONG + " end"), (11, "pre " + LEAK + " post"), (None, BASE), (None, "no id here"), (12, "é日🙂 x"),
    (13, "same"), (13, "same"), (14, "a@b.c_x@y.z 1.2.3.4.5.6.7.8 4111 1111 1111 1111 +1 (988) 555-2485 999.1.1.1"),
    (15, "token = \"abcdef0123456789abcdef0123456789abcdef01\""), (16, "shared\n" * 3 + "own"),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src0", len(t or ""), "clash", 1.0) for i, t in AWKWARD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, digest string, score double"
    ).repartition(5)


@pytest.fixture(scope="module")
def folder_docs(spark):
    return common.documents(spark, TEST_FOLDER)


def pairs(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def empty(docs):
    return docs.where("false")


def windows_removed(rows, size=13):
    first: dict[tuple, float] = {}
    words = [(float("inf") if i is None else i, WORD.findall(t)) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), (doc_id, _) in zip(words, rows):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("which", ["docs", "folder_docs"])
def test_substring_dedup(which, request):
    frame = request.getfixturevalue(which)
    got = substring_dedup.remove_repeated(frame).drop("kept_text").collect()
    assert Counter(tuple(r) for r in got) == windows_removed(pairs(frame))


def components(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), t))
        sets.append({tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set())
    group = list(range(len(rows)))

    def find(a):
        while group[a] != a:
            a = group[a]
        return a

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x]).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                group[find(k)] = find(j)
        for x in s:
            holders[x].append(k)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)].append(i)
    low = {g: min((i for i in some if i is not None), default=None) for g, some in ids.items()}
    return Counter((i, len(s), low[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("which", ["docs", "folder_docs"])
def test_shingle_join(which, request):
    frame = request.getfixturevalue(which)
    got = shingle_join.link_components(frame).drop("digest").collect()
    assert Counter(tuple(r) for r in got) == components(pairs(frame))


def test_shingle_join_chain_through_hub_rounds(spark, monkeypatch):
    """A chain of near copies, each linked only with its neighbours, is one component in any mode."""
    monkeypatch.setattr(shingle_join, "PAIRS_PER_POSTING", 0)
    rows = [(k, " ".join(f"v{x}" for x in range(3 * k, 3 * k + 60))) for k in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = shingle_join.link_components(frame).drop("digest").collect()
    assert Counter(tuple(r) for r in got) == components(rows)
    assert {r.component_id for r in got} == {0}


def test_line_dedup(spark, docs):
    rows = pairs(docs)
    keys = [[x.strip(" \t\n\x0b\f\r").lower() for x in t.split("\n")] for _, t in rows]
    seen = defaultdict(set)
    for (i, _), ks in zip(rows, keys):
        for k in ks:
            seen[k].add(i)
    want = Counter()
    for (i, t), ks in zip(rows, keys):
        kept = [x for x, k in zip(t.split("\n"), ks) if not (k and len(seen[k]) >= 3)]
        want[i, len(ks), len(ks) - len(kept), "\n".join(kept)] += 1
    got = line_dedup.drop_frequent_lines(docs, min_docs=3)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()) == want
    one = spark.createDataFrame([(k, "Common \nline %d" % k + "\nx" * 70) for k in range(12)], "doc_id long, text string")
    kept = line_dedup.drop_frequent_lines(one).collect()
    assert all(r.kept_text == f"line {r.doc_id}" and r.n_dropped == 71 and r.n_lines == 72 for r in kept)


@pytest.mark.parametrize("which", ["docs", "folder_docs"])
def test_byte_pairs(which, request):
    import public_tokenizers
    import tiktoken

    frame = request.getfixturevalue(which)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((i, np.array(known.encode_ordinary(t), "<u4").tobytes(), t.encode()) for i, t in pairs(frame))
    got = byte_pairs.tokenized(frame).collect()
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want


def test_long_pieces_merge_as_short_ones_do():
    import public_tokenizers

    vocabulary = byte_pairs.Vocabulary(*byte_pairs.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    encoder = byte_pairs.Encoder(vocabulary, public_tokenizers.PATTERN)
    for piece in ("abcabcabc" * 12, "$" * 150, "theandingth" * 9):
        assert vocabulary.merge_long(piece.encode()) == np.frombuffer(encoder.encode([piece])[0], "<u4").tolist()


def passages(rows, items):
    def words(t):
        return [w for w in re.split(r"""[\x09-\x0D\x20.,;:!?"'()]+""", t.lower()) if w]

    def shingles(w):
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))

    weight = lambda c: sum(n * sum(map(len, s)) for s, n in c.items())
    out = set()
    for i, t in rows:
        w = words(t)
        for item, text in items:
            want, n = shingles(words(text)), len(words(text))
            if not want or not want.keys() & shingles(w).keys():
                continue
            for at in range(max(len(w) - n, 0) + 1):
                inside = shingles(w[at : at + n])
                common_weight = weight(inside & want)
                if 100 * common_weight >= 80 * (weight(inside) + weight(want) - common_weight):
                    out.add((i, item))
    return out


def test_decontamination(spark, docs, folder_docs):
    changed = LEAK.replace("item19", "other")
    bench = spark.createDataFrame([(1, LEAK), (2, changed), (3, None), (4, "too short"), (None, BASE)], "item_id long, text string")
    got = decontamination.find_passages(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == passages(pairs(docs), [(r.item_id, r.text or "") for r in bench.collect()])
    assert decontamination.find_passages(docs, bench.where("false")).count() == 0
    items = common.load(spark, TEST_FOLDER, "benchmark")
    want = passages(pairs(folder_docs), [(r.item_id, r.text) for r in items.collect()])
    assert want and {(r.doc_id, r.item_id) for r in decontamination.find_passages(folder_docs, items).collect()} == want


def test_fingerprints(spark, docs, tmp_path):
    path = str(tmp_path)
    docs.where("doc_id is not null and doc_id <> 13").write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: r for r in fingerprints.op7(spark, path).collect()}
    rows = sorted(pairs(docs.where("doc_id is not null and doc_id <> 13")), reverse=True)
    for k, (i, t) in enumerate(rows):
        other, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + other[:half]).encode()).hexdigest()
    assert got[1].fingerprint == got[2].fingerprint and got[2].near_next == 1.0
    # The guarantee: every K + WINDOW - 1 = 6 words in common share a choice; positions are kept.
    places = [int(x.split(":")[1]) for x in got[1].fingerprint.split(",")]
    assert places == sorted(places) and max(b - a for a, b in zip(places, places[1:])) <= fingerprints.WINDOW
    assert set(got[3].fingerprint.split(",")) & set(got[1].fingerprint.split(","))
    assert fingerprints.with_next(docs).count() == len(AWKWARD) and fingerprints.with_next(empty(docs)).count() == 0


def test_personal_data(spark, tmp_path):
    rows = [(i, t) for i, t in AWKWARD] + [
        (20, "x" * 5000 + " mail bob (at) site.org or +44 20 7946 0958"), (21, "5" * 5000), (22, "call (415) 555-0134 now"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    patterns = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]

    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "card":
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d)))
            return 14 <= len(d) <= 19 and total % 10 == 0
        return kind == "email" or (all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else 10 <= len(d) <= 15)

    want = Counter()
    for i, t in rows:
        found = sorted(
            (m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(patterns)
            for m in re.finditer(p, t or "") if valid(kind, m.group())
        )
        text = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)
        want[i, *(sum(x[2] == kind for x in found) for kind, _ in patterns), hashlib.sha256(text.encode()).hexdigest()] += 1
    got = personal_data.op2(spark, str(tmp_path)).collect()
    assert Counter(tuple(r)[:6] for r in got) == want


def test_secrets(spark, docs):
    found = secrets.find_secrets(docs.unionByName(docs.limit(0))).collect()
    texts = {i: t for i, t in AWKWARD}
    spans = {texts[r.doc_id][r.start : r.end] for r in found}
    assert "abcdef0123456789abcdef0123456789abcdef01" in spans
    assert all(r.match_sha256 == hashlib.sha256(texts[r.doc_id][r.start : r.end].encode()).hexdigest() for r in found)
    assert secrets.find_secrets(empty(docs)).count() == 0


@pytest.mark.parametrize("module, label, query", [(toxicity, "toxic", "op9_toxicity"), (line_quality, "quality", "op4_line_quality")])
def test_classifiers(spark, docs, module, label, query):
    folder = TEST_FOLDER.replace("0.001", "0.1")
    got = common.QUERIES[query](spark, folder).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    known = got.merge(common.load(spark, folder, "labels").toPandas(), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held[label]).mean() > 0.96
    rank = held.score.rank()
    good = held[label] == 1
    assert (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum()) > 0.95
    # Every row gets a score, whatever it holds, also without labels.
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scorer = module.score if module is toxicity else module.with_score
    for labels in (nothing, common.load(spark, folder, "labels")):
        scored = scorer(docs, module.fit_sample(common.documents(spark, folder), labels)).collect()
        assert len(scored) == len(AWKWARD) and all(0 <= r.score <= 1 for r in scored)


def test_operators_take_empty_tables(docs):
    none = empty(docs)
    assert substring_dedup.remove_repeated(none).count() == 0
    assert shingle_join.link_components(none).count() == 0
    assert line_dedup.drop_frequent_lines(none).count() == 0
    assert byte_pairs.tokenized(none).count() == 0
    assert personal_data.find_personal_data(none).count() == 0


def test_pipeline_stages(spark, folder_docs):
    frame, kept = folder_docs, []
    for name, stage in corpus_pipeline.STAGES:
        before = frame
        frame = common.stored(stage(spark, before, TEST_FOLDER), "stage")
        kept.append(frame.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == folder_docs.columns
        if name == "n-gram Jaccard join":
            assert kept[-1] == len({c for (_, _, c) in components(pairs(before))})
        if name == "benchmark decontamination":
            items = common.load(spark, TEST_FOLDER, "benchmark")
            bad = {i for i, _ in passages(pairs(before), [(r.item_id, r.text) for r in items.collect()])}
            assert {i for i, _ in pairs(frame)} == {i for i, _ in pairs(before)} - bad
    assert kept == sorted(kept, reverse=True) and kept[-1] > 100
    ran = corpus_pipeline.run(spark, TEST_FOLDER)
    assert Counter(map(tuple, ran.collect())) == Counter(map(tuple, frame.collect()))


def test_near_copies_keeps_one_row_of_every_component(spark):
    """Components that share a name, through NULL or repeated doc_ids, stay apart."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    table = [
        (None, "first text without an id"), (None, "second text, other words"), (None, "second text, other words"),
        (3, a), (9, a.replace("a30 ", "changed ")), (3, b), (10, b.replace("b30 ", "changed ")),
        (None, c), (4, c.replace("c30 ", "changed ")), (None, ""), (None, " \n"), (5, ""), (6, ""), (6, ""), (None, None),
    ]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in table],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_copies(spark, frame.repartition(4), TEST_FOLDER).select("doc_id", "text").collect()
    assert Counter(map(tuple, got)) == Counter([
        (None, table[0][1]), (None, table[1][1]), (3, a), (3, b), (4, c.replace("c30 ", "changed ")),
        (None, ""), (None, " \n"), (5, ""), (6, ""), (None, None),
    ])


def test_secrets_of_any_form(spark):
    """Short, symbolic, digitless and glued secrets; false runs in the same table."""
    aws, git = "AKIA" + "ABCDEFGH12345678", "ghp_" + "a1B2c3D4e5F6" * 3
    cases = {
        1: ('é🙂 password = "hunter2" end', "hunter2"), 2: ('password = "P@ssw0rd!2024"', "P@ssw0rd!2024"),
        3: ('api_key = "correcthorsebatterystaple"', "correcthorsebatterystaple"), 4: ("see x/" + aws, aws),
        5: ("key_" + git + " glued", git), 6: ("credential: s3cr&t\nmore", "s3cr&t"), 7: ("{'passwd': 'two words'}", "two words"),
        8: ("passwd=token=abc", "abc"), 9: ("secret = 'it is", "it"),
    }
    rows = [(i, t) for i, (t, _) in cases.items()] + [(100 + k, f"see file-{k:06d}-of-report-{k * 7:05d} there") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    every = Counter((r.doc_id, r.start, r.end) for r in secrets.findings(frame).collect())
    for i, (text, want) in cases.items():
        start = text.rindex(want)
        assert every[i, start, start + len(want)] == 1, text
    assert set(every.values()) == {1}
    spans = {(r.doc_id, dict(rows)[r.doc_id][r.start : r.end]) for r in secrets.find_secrets(frame).collect()}
    assert {(i, want) for i, (_, want) in cases.items()} <= spans
    assert not any(i >= 100 for i, _ in spans)
