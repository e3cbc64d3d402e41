"""Operators over the whole corpus: joins, dedup, mixing, packing, the pipeline."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from graphspark.llm import exact_packing, line_dedup, parity_join, pivotal_mix
from graphspark.llm.components import components

from .conftest import BASE, LONG, ROWS, RUN, SF

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOKENS = public_tokenizers.path("word_bpe_49k.json")


def brute_components(rows):
    sets, root = {}, {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
        root[d] = d

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(s), find(d)) for d, s in sets.items()}


def joined(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity_join.join(df)[0].collect()}


def test_join_equals_brute_force(real):
    rows = [(r["doc_id"], r["text"]) for r in real["documents"].collect()]
    assert joined(real["documents"]) == brute_components(rows)


def test_join_of_edited_copies_and_edges(spark, docs, no_docs):
    rng = np.random.default_rng(5)
    rows, n = [(d, t) for d, t, *_ in ROWS if d is not None and d != 5], 100
    for size in (5, 7, 12, 40, 130):  # chains of copies on both sides of the limit
        base = rng.integers(0, 10 ** 6, size)
        for _ in range(12):
            copy = base.copy()
            at = rng.integers(0, size, rng.integers(0, 1 + size // 20 + 1))
            copy[at] = rng.integers(0, 10 ** 6, len(at))
            rows.append((n, " ".join(map(str, copy))))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df) == brute_components(rows)
    edge = parity_join.join(docs)[0].collect()
    assert len(edge) == len(ROWS)
    assert [r["component_id"] for r in edge if r["doc_id"] is None] == [None]
    assert {r["doc_id"]: r["component_id"] for r in edge if r["doc_id"] in (1, 2, 6, 7, 8, 9)} == {1: 1, 2: 2, 6: 6, 7: 6, 8: 6, 9: 6}
    assert parity_join.join(no_docs)[0].count() == 0
    left = parity_join.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 1, 2, 3, 4, 5, 6, 11, 12]


def test_join_stores_less_than_the_texts(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(d, " ".join(map(str, rng.integers(0, 10 ** 6, 300)))) for d in range(60)]
    rows.append((60, rows[0][1] + " more words"))
    stored, keep = [], parity_join.materialize
    monkeypatch.setattr(parity_join, "materialize", lambda df: stored.append(keep(df)) or stored[-1])
    left = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(60))
    values = sum(len(r[c]) if isinstance(r[c], list) else 1 for df in stored for r in df.collect() for c in df.columns)
    assert 8 * values < sum(len(t) for _, t in rows)  # the keys of all blocks would take more


def test_join_does_not_need_the_same_document_to_send_keys(spark, monkeypatch):
    rng = np.random.default_rng(10)
    base = rng.integers(0, 10 ** 6, 60)
    text, near = (" ".join(map(str, w)) for w in (base, np.r_[base[:-1], 7]))
    rows = [(1, text), (2, near), (3, near), (4, text), (5, near), (5, text), (6, "other words " + near[::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    keys = parity_join.key_rows
    monkeypatch.setattr(parity_join, "key_rows", lambda d, *more: keys(d.orderBy("doc_id", ascending=False).coalesce(1), *more))
    got = sorted((r["doc_id"], r["component_id"]) for r in parity_join.join(docs)[0].collect())
    assert got == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (5, 1), (6, 6)]


def test_pipeline_takes_near_copies_of_five_words(spark):
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base)), (1, " ".join(base[:90] + [f"x{k}" for k in range(17)] + base[107:]))]  # 175 of 217
    for n in range(2, 122, 6):  # on both sides of the limit
        text = [f"t{n}_{k}" for k in range(int(rng.integers(3, 150)))]
        for d in range(n, n + 6):
            copy, at = list(text), int(rng.integers(0, len(text)))
            width = int(rng.integers(0, 2 + len(text) // 9))
            copy[at:at + width] = [f"c{d}_{k}" for k in range(len(copy[at:at + width]))]
            rows.append((d, " ".join(copy)))
    sets, comp = {}, {}
    for d, t in rows:
        w = t.split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))}
        near = {comp[e] for e in comp if 100 * len(sets[d] & sets[e]) >= 80 * len(sets[d] | sets[e])}
        low = min(near | {d})
        comp = {e: low if c in near else c for e, c in comp.items()} | {d: low}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.near_copies(spark, docs, SF).collect()
    assert comp[1] == 0 and sorted(r["doc_id"] for r in left) == sorted(set(comp.values()))


def test_one_large_group_of_copies(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 10 ** 6, 100)
    rows = []
    for n in range(120):
        copy = base.copy()
        copy[rng.integers(0, 100, 2)] = rng.integers(0, 10 ** 6, 2)
        rows.append((n, " ".join(map(str, copy))))
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_bounds_never_exclude_a_link():
    for percent in (50, 85):
        for a in range(1, 120):
            for b in range(a, 120):
                for shared in range(a + 1):
                    if 100 * shared >= percent * (a + b - shared):
                        assert a + b - 2 * shared <= parity_join.most_different(a + b, percent)
        bands = parity_join.Bands(percent)
        for a in range(1, 400):
            for b in range(a, a * 100 // percent + 1):
                assert bands.of(b)[0] in bands.of(a)
                assert parity_join.most_different(a + b, percent) <= max(bands.blocks[bands.of(b)[0]] - 1 - bands.spare[bands.of(b)[0]], 0)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (500, 501)]
    out = {r["id"]: r["comp"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(41)) and all(out[100 + k] == 100 for k in range(30)) and out[501] == 500
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows):
    """Lines of runs of 50 words or more that stand in an earlier place."""
    seqs, places = [], defaultdict(list)
    for d, t in rows:
        seq = [(i, x, len(WORD.findall(x))) for i, x in enumerate(t.split("\n")) if WORD.search(x)]
        for p, (_, x, _) in enumerate(seq):
            places[x].append((len(seqs), p))
        seqs.append((d, seq))
    gone = {}
    for k, (d, s) in enumerate(seqs):
        out = set()
        for p in range(len(s)):
            for k2, p2 in places[s[p][1]]:
                if (k2, p2) >= (k, p):
                    break
                s2, q = seqs[k2][1], 0
                while p + q < len(s) and p2 + q < len(s2) and s[p + q][1] == s2[p2 + q][1]:
                    q += 1
                if sum(x[2] for x in s[p:p + q]) >= 50:
                    out |= {x[0] for x in s[p:p + q]}
        gone[d] = sorted(out)
    return gone


def test_line_dedup_equals_brute_force(real):
    rows = sorted((r["doc_id"], r["text"]) for r in real["documents"].collect())
    out = line_dedup.cleaned(real["documents"]).select("_row.doc_id", "_gone", "_text").collect()
    gone, texts = brute_lines(rows), dict(rows)
    for r in out:
        assert r["_gone"] == gone[r["doc_id"]]
        keep = [x for i, x in enumerate(texts[r["doc_id"]].split("\n")) if i not in set(gone[r["doc_id"]])]
        assert r["_text"] == "\n".join(keep)


def said(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_line_dedup_takes_the_tail_of_a_run(spark):
    w, c, b = said("w", 55), said("c", 55), said("b", 20)
    rows = [(1, f"{w}\n{said('other', 30)}"), (2, f"{c}\n{w}\n{b}"), (3, f"{c}\n{w}\n{b}")]
    rng = np.random.default_rng(9)  # texts cut from a few passages, so that runs go on in different ways
    pool = [said(f"p{k}_", int(rng.choice([1, 4, 9, 20, 30, 49, 50, 60]))) for k in range(12)]
    passages = [[int(x) for x in rng.integers(0, 12, 9)] for _ in range(5)]
    for d in range(10, 130):
        lines = []
        for _ in range(int(rng.integers(1, 4))):
            part = passages[int(rng.integers(0, 5))]
            a, z = sorted(rng.integers(0, 10, 2))
            lines += [pool[k] for k in part[a:z]] + [f"own{d}"] * int(rng.integers(0, 2))
        rows.append((d, "\n".join(lines)))
    gone = brute_lines(rows)
    assert gone[3] == [0, 1, 2]
    out = line_dedup.cleaned(spark.createDataFrame(rows, "doc_id long, text string")).select("_row.doc_id", "_gone")
    assert {r["doc_id"]: r["_gone"] for r in out.collect()} == gone


def test_line_fingerprints_are_window_minima(spark):
    rng = np.random.default_rng(4)
    words = [int(x) for x in rng.integers(1, 30, 200)]
    hashes = [int(x) for x in rng.integers(0, 9, 200)]  # many ties
    chosen = line_dedup.winnow(hashes, words)
    for a, b in line_dedup.windows(words):
        assert sum(words[a:b]) >= 50 and (sum(words[a + 1:b]) < 50 or sum(words[a:b - 1]) < 50)
        place = max(i for i in range(a, b) if hashes[i] == min(hashes[a:b]))
        assert (a, b) in chosen[place]
    rows = [(1, f"{said('a', 60)}\n{said('b', 60)}"), (2, f"{said('b', 60)}\n{said('c', 60)}"), (3, None), (4, "")]
    places = line_dedup.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["_id"], r["_at"]) for r in places.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    shared = line_dedup.shared_places(places)
    assert sorted((r["_id"], r["_at"]) for r in shared.collect()) == [(1, 1), (2, 0)]
    runs = line_dedup.merged(line_dedup.extended(shared)).collect()
    assert [(r["_id"], [tuple(x) for x in r["_runs"]]) for r in runs] == [(2, [(0, 1)])]


def test_line_dedup_runs_merge_and_may_be_shuffled(spark, monkeypatch):
    lines = [said(f"l{i}_", 7) for i in range(60)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["own"] + lines + ["end"] + lines[20:40])), (2, "\n".join(lines))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    runs = {(r["_id"], len(r["_runs"])): sorted(tuple(x) for x in r["_runs"])
            for r in line_dedup.repeated_runs(docs).collect()}
    assert runs == {(2, 2): [(1, 61), (62, 82)], (2, 1): [(0, 60)]}
    sent = sorted(r["_text"] for r in line_dedup.cleaned(docs).collect())
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    assert sorted(r["_text"] for r in line_dedup.cleaned(docs).collect()) == sent == ["", "\n".join(lines), "own\nend"]


def test_line_dedup_edges(docs, no_docs):
    out = line_dedup.dedup(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(ROWS) and line_dedup.dedup(no_docs).count() == 0
    assert rows[12]["text"] == f"first\n{RUN}\nlast" and rows[13]["text"] == "other\nend"
    assert rows[13]["n_chars"] == len("other\nend") and rows[1]["text"] is None and rows[2]["text"] == ""
    assert rows[7]["text"] == "" and rows[6]["text"] and rows[5]["text"] == LONG
    assert all(r["text"] == rows[9]["text"] for r in out.where("doc_id = 9").collect())  # repeated rows stay alike


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, out = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0)
    free = set(names)
    while free:
        left = goal - sum(out[s] for s in names if s not in free)
        for s in free:
            out[s] = left * w[s] / sum(w[x] for x in free)
        over = {s for s in free if out[s] > 2 * sizes[s]}
        for s in over:
            out[s] = 2.0 * sizes[s]
        free -= over
        if not over:
            break
    return out


@pytest.mark.parametrize("which", ["real", "edge"])
def test_mix_meets_targets(real, docs, which):
    df = real["documents"] if which == "real" else docs
    rows = pivotal_mix.copies(df, "doc_id", "source").collect()
    size = Counter()
    for r in df.select("source", "text").collect():
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    want, taken, largest = brute_targets(size), Counter(), Counter()
    for r in rows:
        assert r["_size_sum"] == size[r["source"]] and r["_target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["_copies"] <= 2
        taken[r["source"]] += r["_copies"] * r["_size"]
        largest[r["source"]] = max(largest[r["source"]], r["_size"])
    assert len(rows) == df.count()
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in size)
    again = pivotal_mix.copies(df.repartition(5), "doc_id", "source").collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_mix_repeats_rows_and_keeps_columns(docs, no_docs):
    out = pivotal_mix.mix(docs)
    assert out.columns == docs.columns
    n = Counter(r["doc_id"] for r in out.collect())
    copies = Counter()
    for r in pivotal_mix.copies(docs.selectExpr("coalesce(cast(doc_id as string), '-') as _doc", "coalesce(sha2(text, 256), '-') as _sha",
                                                "source", "text"), "_doc", "_sha", "source").collect():
        copies[None if r["_doc"] == "-" else int(r["_doc"])] += r["_copies"]
    assert n == +copies
    assert pivotal_mix.mix(no_docs).count() == 0 and pivotal_mix.copies(no_docs, "doc_id").count() == 0


def test_large_documents_are_rounded_against_the_rest():
    size = np.array([20_000.0] + [300.0] * 200)
    total, first = 0.4 * size.sum(), []
    for seed in range(400):
        part = np.full(len(size), 0.4)
        held = pivotal_mix._round_group(size, part, seed)
        assert part @ size == pytest.approx(total) and (held is None or size[held] == 300)
        first.append(part[0])
    assert set(np.round(first, 6)) == {0, 1} and abs(np.mean(first) - 0.4) < 0.1


def test_equal_rows_share_their_copies(spark, monkeypatch):
    rows = [(None, "s", "two words")] * 5000 + [(i, "s", "one two three") for i in range(50)] + [(1, "t", "x y")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    monkeypatch.setattr(pivotal_mix, "EQUAL_ROWS", 300)
    out = pivotal_mix.copies(docs, "doc_id", "source").collect()
    assert Counter((r["doc_id"], r["source"]) for r in out) == Counter((d, s) for d, s, _ in rows)
    nulls = [r["_copies"] for r in out if r["doc_id"] is None]
    assert set(nulls) <= {1, 2} and max(nulls) <= 2
    want = {r["source"]: r["_target"] for r in out}
    for s in want:
        assert abs(sum(r["_copies"] * r["_size"] for r in out if r["source"] == s) - want[s]) <= 3
    groups = pivotal_mix.counted(docs, "doc_id", "source").collect()
    assert len(groups) == 52 and sum(r["_rows"] for r in groups) == len(rows)
    ident = docs.selectExpr("coalesce(cast(doc_id as string), '-') as _doc", "coalesce(sha2(text, 256), '-') as _sha",
                            "source", "text")
    taken = sum(r["_copies"] for r in pivotal_mix.counted(ident, "_doc", "_sha", "source").collect())
    assert pivotal_mix.mix(docs).count() == taken


def test_rounding_is_unbiased():
    size, want = np.array([3.0, 5, 7, 11, 2, 9]), np.array([0.2, 0.5, 0.7, 0.35, 0.9, 0.6])
    total = np.zeros(6)
    for seed in range(4000):
        part = want.copy()
        held = pivotal_mix._round_group(size, part, seed)
        assert (part * size).sum() == pytest.approx((want * size).sum())
        assert sum(0 < p < 1 for p in part) == (held is not None)
        total += part
    assert np.abs(total / 4000 - want).max() < 0.03


def test_encoding_equals_the_tokenizer(real):
    tokenizer = Tokenizer.from_file(TOKENS)
    rng = np.random.default_rng(1)
    odd = ["a", "B", "'s", "'LL", "é", "e\u0301", " ", "\n", "\xa0", "\u2003", "\u03a3", "\u0130", "1", "23", "\u6f22", "\xd7", "ß",
           "<|endoftext|>", "<|", "!!", "\ufb01", "\x1c", "\x85", "\u200b", "\U0001f600"]
    texts = [r["text"] for r in real["documents"].collect()] + ["".join(rng.choice(odd, rng.integers(0, 25))) for _ in range(2000)]
    ids, edges = exact_packing.encode(pa.array(texts), TOKENS)
    for text, a, b in zip(texts, edges[:-1], edges[1:]):
        assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("which", ["real", "edge", "none"])
def test_packing(real, docs, no_docs, which):
    df = {"real": real["documents"], "edge": docs, "none": no_docs}[which]
    rows = exact_packing.pack(df, TOKENS, "doc_id").collect()
    tokenizer = Tokenizer.from_file(TOKENS)
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a:a + 2048]
            want[r["doc_id"], k, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(held) <= 1.02 * -(-sum(r["length"] for r in rows) // 2048) + 1


def test_plan_fills_gaps_exactly():
    plan = exact_packing.plan({1500: 2, 548: 1, 300: 1, 248: 1, 700: 1, 1000: 1, 348: 1})
    assert sorted(sum(p) for p, _ in plan) == [2048, 2048, 2048]
    assert exact_packing.plan({2048: 10 ** 12}) == [((2048,), 10 ** 12)]
    assert exact_packing.plan({1024: 3}) == [((1024, 1024), 1), ((1024,), 1)]
    assert exact_packing.plan({}) == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF))
        assert docs.columns == columns, name
        seen.append(docs.count())
    assert seen[1] < seen[0] and seen[2] == seen[1] and seen[3] <= seen[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "mix", "packing"]


def test_pipeline_on_edge_rows(spark, docs, no_docs):
    """Null, empty, long, equal and repeated rows with clashing columns through all stages, one after the other."""
    kept = corpus_pipeline.materialize(corpus_pipeline.quality(spark, docs, SF))
    words = {None: 0} | {t: len((t or "").split()) for t in (r["text"] for r in docs.collect())}
    assert all(words[r["text"]] >= 10 for r in kept.collect())
    for start in (docs, no_docs):
        rows = start
        for name, stage in corpus_pipeline.STAGES[1:-1]:
            before = rows
            rows = corpus_pipeline.materialize(stage(spark, rows, SF))
            assert rows.columns == docs.columns and rows.where("_row != 'r' or _size != 's' or hi != 'h'").count() == 0
            if name == "line_dedup":
                assert rows.count() == before.count()
                assert sum(RUN in (r["text"] or "") for r in rows.collect()) == min(1, start.count())
            if name == "ngram_join":
                texts = [r["text"] for r in rows.collect()]
                assert len([t for t in texts if t and t.startswith(BASE[:200])]) == min(1, start.count())
                assert {r["doc_id"] for r in rows.collect()} >= ({1, 2, 3, 4, 5, 6, 11} if start is docs else set())
        packed = corpus_pipeline.packing(spark, rows, SF).collect()
        assert sum(r["piece"] == 0 for r in packed) == rows.count()
