"""Operators that judge or mark each row by itself."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from graphspark.llm import compression_quality, host_reputation, language_mixture, license_rules, quality_rules, winnowing
from graphspark.llm.common import coded_words, words_of

from .conftest import LONG, ROWS

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def test_words_follow_the_rule_in_both_forms():
    import pyarrow as pa
    texts = [" a\x1cb c\n\n", "", "x\x85y\xa0z w", "\t\x0b\x0c", "plain words only", "é\u2003f g"]
    different, codes, starts = coded_words(pa.array([*texts, None]))
    for text, a, b in zip(texts, starts[:-1], starts[1:]):
        assert words_of(text) == WORD.findall(text)
        assert different.take(pa.array(codes[a:b])).to_pylist() == WORD.findall(text)
    assert starts[-1] == starts[-2]


def brute_stats(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_rule_statistics_equal_brute_force(real):
    texts = [r["text"] for r in real["documents"].collect()]
    texts += [None, "", " \n", "a b c d e a b c d e a", "x " * 50, "l\nl\n\nl", " ".join(map(str, range(9000))) * 2]
    for text in texts:
        assert quality_rules.rule_stats(text)[:5] == brute_stats(text)


def test_distinct_words_are_counted_in_the_whole_text():
    rng = np.random.default_rng(3)
    at = [quality_rules.FEATURES.index(x) - len(quality_rules.FEATURES) for x in quality_rules.FEATURES if "distinct" in x]
    varied = [f"w{k}" for k in range(4000)]
    few = [f"w{k}" for k in rng.integers(0, 12, 3950)]
    for words in (varied, varied[:100] + few, few[:100] + varied[100:], varied[:60], varied[:140] + few[:20], varied[:100]):
        n = len(words)
        blocks = [words[a:a + 100] for a in range(0, n - 99, 100)] + ([words[-100:]] if n % 100 else [])
        shares = [len(set(b)) / len(b) for b in blocks]
        stats = quality_rules.rule_stats(" ".join(words))
        assert [stats[k] for k in at] == pytest.approx([np.mean(shares), min(shares)])
    hidden, clean = (quality_rules.rule_stats(" ".join(w)) for w in (varied[:100] + few, varied))
    assert all(hidden[k] < clean[k] / 2 for k in at)


def test_rules_keep_prose_and_reject_junk(spark, real, docs, no_docs, labels):
    rows = quality_rules.judge(real["documents"], real["labels"], "doc_id").select("doc_id", "_verdict.*")
    quality = {r["doc_id"]: r["quality"] for r in real["labels"].collect()}
    out = [r for r in rows.collect() if r["doc_id"] in quality]
    good = [r["kept"] for r in out if quality[r["doc_id"]]]
    bad = [r["kept"] for r in out if not quality[r["doc_id"]]]
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.3 * len(bad)
    assert all(r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) for r in out)
    assert not any(r["kept"] for r in out if r["base_failed"])
    few = quality_rules.judge(docs, labels, "doc_id", "text").select("doc_id", "text", "_verdict.*").collect()
    assert len(few) == len(ROWS)
    assert not any(r["kept"] for r in few if not r["text"] or r["n_words"] < 10)
    assert quality_rules.judge(no_docs, labels, "doc_id").count() == 0
    unjudged = quality_rules.judge(docs, labels.limit(0), "doc_id").select("_verdict.*").collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in unjudged)  # without labels the base rule decides
    left = quality_rules.kept(docs, labels.limit(0))
    assert left.columns == docs.columns and left.where("_row != 'r'").count() == 0


def test_path_lengths_equal_a_plain_walk():
    rng = np.random.default_rng(5)
    x = np.r_[rng.normal(0, 1, (300, 4)), rng.normal(6, 1, (5, 4)), np.zeros((3, 4))]
    forest, expected, limit = model = quality_rules.fit_forest(x[:300], x)

    def walk(tree, row, at=0):
        feature, cut, left, right, length = (col[at] for col in tree)
        return length if feature < 0 else walk(tree, row, left if row[feature] <= cut else right)

    def leaves(tree, rows, at=0, depth=0):
        """Each leaf's length is its depth and what its rows would still need."""
        feature, cut, left, right, length = (col[at] for col in tree)
        if feature < 0:
            n = len(rows)
            more = 0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
            assert length == pytest.approx(depth + more) and depth <= limit
            return n
        side = rows[:, feature] <= cut
        return leaves(tree, rows[side], left, depth + 1) + leaves(tree, rows[~side], right, depth + 1)

    got = quality_rules.anomaly(model, x)
    assert got == pytest.approx([2 ** (-np.mean([walk(t, row) for t in forest]) / expected) for row in x])
    assert got[300:305].min() > np.quantile(got[:300], 0.95)  # rows far from the others have short paths
    everything = np.random.default_rng(quality_rules.SEED)
    part = x[:300][everything.choice(300, min(quality_rules.TREE_ROWS, 300), replace=False)]
    assert leaves(forest[0], part) == len(part)


def test_winnowing_guarantee_and_ties():
    rng = np.random.default_rng(3)
    letters = np.array(list("abc "))
    span = winnowing.GRAM + winnowing.WINDOW - 1
    for _ in range(30):
        shared = "".join(rng.choice(letters, span))
        a = "".join(rng.choice(letters, 90)) + shared + "".join(rng.choice(letters, 70))
        b = shared + "".join(rng.choice(letters, 200))
        (ha, pa_), (hb, pb) = winnowing.winnow(a), winnowing.winnow(b)
        assert set(ha) & set(hb)
        assert [a[p:p + winnowing.GRAM] for h, p in zip(ha, pa_) if h in set(hb)]
        h = winnowing.gram_hashes(a)
        chosen = {max(i for i in range(s, s + winnowing.WINDOW) if h[i] == h[s:s + winnowing.WINDOW].min())
                  for s in range(len(h) - winnowing.WINDOW + 1)}
        assert sorted(chosen) == pa_.tolist()
        back = winnowing.from_string(winnowing.to_string(ha, pa_))
        assert back[0].tolist() == ha.tolist() and back[1].tolist() == pa_.tolist()
    assert len(winnowing.winnow("a" * 5000)[0]) > 1 and winnowing.winnow("")[0].size == 0


def test_fingerprints_of_edited_texts(spark, docs, no_docs):
    rows = [(d, t) for d, t, *_ in ROWS if d is not None and d != 9]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in winnowing.compare_edited(df).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after, r = t or "", after or "", out[d]
        changed = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == winnowing.to_string(*winnowing.winnow(t))
        own, other, following = (set(winnowing.winnow(x)[0].tolist()) for x in (t, changed, after))
        for near, of in (("near_edited", other), ("near_next", following)):
            assert r[near] == pytest.approx(len(own & of) / len(own | of) if own | of else 1.0)
    assert out[6]["fingerprint"] == out[7]["fingerprint"] and out[7]["near_next"] == 1.0
    assert out[2]["near_next"] == 1.0 and out[2]["fingerprint"] == ""  # two empty texts
    assert winnowing.compare_edited(docs).count() == len(ROWS)
    assert winnowing.compare_edited(no_docs).count() == 0
    assert winnowing.compare_edited(df.where("doc_id = 5")).first()["near_next"] == 1.0  # its own next


def test_host_rules_and_paths(spark, labels):
    urls = [(1, "http://WWW.Example.com/en/1?x=/"), (2, "https://m.example.com/en/a"), (3, "ftp://a.net/fr/x#y"),
            (4, None), (5, "nothing"), (6, "x://"), (7, "http://a.org"), (8, "http://a.net?/es/"), (9, "http://com/z"),
            (10, "http://example.com"), (10, "http://example.com"), (11, "http://a.net/es/1://b/c")]
    df = spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "1 as host", "2 as n", "3 as mean")
    out = [tuple(r)[:5] for r in host_reputation.judge(df, labels).orderBy("page_id").collect()]
    assert out == [
        (1, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (2, "m.example.com", "/en/a", "example.com/en/", "block"), (3, "a.net", "/fr/x", "net/fr/", "block"),
        (4, "", "", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "a.org", "", None, "allow"),
        (8, "a.net", "", None, "allow"), (9, "com", "/z", "com/", "allow"), (10, "example.com", "", None, "allow"),
        (10, "example.com", "", None, "allow"), (11, "a.net", "/es/1://b/c", "net/es/", "block")]
    assert host_reputation.judge(df.limit(0), labels).count() == 0


def test_reputation_shrinks_to_domain_and_blocks_bad_hosts(spark):
    pages = [(i, f"http://{h}.site.org/en/{i}") for i, h in enumerate(["bad"] * 60 + ["good"] * 60 + ["few"] * 2 + ["none"])]
    known = [(i, 0 if i < 60 or 120 <= i < 122 else 1) for i in range(122)]
    out = {r["host"]: r for r in host_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"),
                                                       spark.createDataFrame(known, "doc_id long, quality int")).collect()}
    bad, good, few, none = (out[f"{h}.site.org"] for h in ("bad", "good", "few", "none"))
    assert bad["verdict"] == "block" and good["verdict"] == "allow" and none["verdict"] == "allow"
    assert good["bad_mean"] < none["bad_mean"] < few["bad_mean"] < bad["bad_mean"]
    assert all(0 <= r["bad_bound"] <= r["bad_mean"] <= 1 for r in out.values())


def test_reputation_of_domains_below_suffixes_of_two_labels(spark):
    """The whole query equals its SQL, and unrelated domains below one suffix don't share a reputation."""
    rng = np.random.default_rng(3)
    hosts = ["a.evil.co.uk", "b.evil.co.uk", "a.good.co.uk", "b.good.co.uk", "x.evil.com:8080", "u@y.evil.com", "good.org.",
             "10.0.0.1", "10.0.0.2:80", "co.uk", "uk", "", "a.net", "m.example.com", "www.example.com"]
    bad = {h: 0.9 if "evil" in h else 0.1 for h in hosts}
    rows = [(i, f"http://{h}/en/{i}" + ("#t" if i % 3 else "?q=/"), int(rng.random() >= bad[h])) for h in hosts
            for i in range(1_000 * hosts.index(h), 1_000 * hosts.index(h) + int(rng.integers(20, 60)))]
    new = [(90_000 + k, f"https://{h}/es/x") for k, h in enumerate(
        ("new.evil.co.uk", "new.good.co.uk", "other.co.uk", "z.evil.com:1", "else.com", "none.zz", "10.0.0.3", "N.Good.Org"))]
    pages = [(i, u) for i, u, _ in rows] + new + [(None, None), (5, "x"), (5, "x")]
    known = [(i, q) for i, _, q in rows] + [(0, 0), (None, 0), (1, None)]
    out = host_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"),
                                spark.createDataFrame(known, "doc_id long, quality int")).toPandas()
    mean = dict(zip(out["host"], out["bad_mean"]))
    assert mean["new.evil.co.uk"] > 0.6 > 0.4 > mean["new.good.co.uk"] and mean["z.evil.com:1"] > 0.6
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(pages, columns=["page_id", "url"]).astype({"page_id": "Int64"}))
    con.register("labels", pd.DataFrame(known, columns=["doc_id", "quality"]).astype("Int64"))
    want = con.execute(host_reputation.ORACLE_SQL).df()
    assert list(want.columns) == list(out.columns) and len(want) == len(out) == len(pages)

    def plain(df):
        return sorted((tuple(None if pd.isna(v) else round(v, 6) if isinstance(v, float) else v for v in r)
                       for r in df.astype({"page_id": "Int64"}).itertuples(index=False)), key=repr)

    assert plain(out) == plain(want)


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_hot_and_null_ids_spread_over_buckets(spark):
    rows = [(None, f"text number {i} " * 3) for i in range(300)] + [(7, f"seven {i} " * 4) for i in range(300)]
    rows += [(i, f"other {i} " * 5) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = df.orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text").collect()
    want = []
    for row, after in zip(order, order[1:] + order[:1]):
        changed = winnowing.edited(row["text"], after["text"])
        want.append((str(row["doc_id"]), winnowing.to_string(*winnowing.winnow(row["text"])),
                     winnowing.to_string(*winnowing.winnow(changed)), hashlib.sha256(changed.encode()).hexdigest()))
    out = [(str(r["doc_id"]), r["fingerprint"], r["edited_fingerprint"], r["edited_sha256"])
           for r in winnowing.compare_edited(df).collect()]
    assert sorted(out) == sorted(want)
    sizes = [r["count"] for r in winnowing._buckets(df).groupBy("_bucket").count().collect()]
    assert max(sizes) < 120


def test_languages_held_out(real, docs, no_docs):
    out = {r["doc_id"]: r for r in language_mixture.identify(real["documents"], "doc_id").collect()}
    held = [r for r in real["documents"].collect() if fold(r["doc_id"])]
    assert sum(out[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    few = language_mixture.identify(docs, "doc_id", "text").collect()
    assert len(few) == len(ROWS)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in few if not (r["text"] or "").strip())
    assert all(0 <= r["score"] <= 1 for r in few)
    assert language_mixture.identify(no_docs, "doc_id").count() == 0
    assert {r["lang_pred"] for r in language_mixture.identify(docs.withColumn("lang", docs.lang.substr(9, 0)).where("lang = 'x'"), "doc_id").collect()} <= {"und"}


def test_mixture_finds_both_languages():
    langs, rng = ["a", "b"], np.random.default_rng(0)
    texts = {"a": "".join(rng.choice(list("abcd "), 4000)), "b": "".join(rng.choice(list("wxyz "), 4000))}
    counts = np.stack([np.bincount(language_mixture.trigram_buckets(texts[k]), minlength=language_mixture.BUCKETS)
                       for k in langs], 1) + 0.5
    table = np.log(counts / counts.sum(0))
    top, score, chosen = language_mixture.infer(texts["a"][:600] + texts["b"][:300], langs, table)
    assert top == "a" and sorted(chosen) == ["a", "b"] and 0.6 < score < 0.75
    assert language_mixture.infer(texts["b"], langs, table)[2] == ["b"]
    for signs in ("123 !!", "\u00bd", "\u00b2 \u2462", "\u2167", "_"):  # numerals and signs, no letter
        assert language_mixture.infer(signs, langs, table) == ("und", 0.0, [])
    assert language_mixture.infer("1 \u0436", langs, table)[0] in langs


def test_mixture_equals_a_plain_loop():
    rng = np.random.default_rng(9)
    likely, n = rng.random((40, 4)) + 0.01, rng.integers(1, 9, 40).astype(float)
    share = [0.25] * 4
    for _ in range(language_mixture.STEPS):
        mass = [0.0] * 4
        for g in range(40):
            whole = sum(share[k] * likely[g, k] for k in range(4))
            for k in range(4):  # each gram is shared out among the languages
                mass[k] += n[g] * share[k] * likely[g, k] / whole
        share = [m / sum(mass) for m in mass]
    value = sum(n[g] * np.log(sum(share[k] * likely[g, k] for k in range(4))) for g in range(40))
    got, fit = language_mixture.proportions(likely, n, np.full(4, 0.25))
    assert got == pytest.approx(share) and fit == pytest.approx(value)


def test_size_difference_and_curve_equal_plain_ones():
    rng = np.random.default_rng(2)
    good, bad = ([" ".join(rng.choice(w, 60)).encode() for _ in range(300)] for w in (
        ["river", "stone", "letter", "morning", "garden"], ["$$$", "click", "xxx", "buy!!", "zzz"]))
    dictionaries = [compression_quality.dictionary(raws) for raws in (good, bad)]
    pair = compression_quality.Pair(*dictionaries)

    def size(raw, dictionary):
        made = zstandard.ZstdCompressor(level=compression_quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary),
                                        write_content_size=False, write_dict_id=False)
        k = compression_quality.BLOCK_BYTES
        return sum(len(made.compress(raw[i:i + k])) for i in range(0, len(raw), k))

    for raw in (good[0], bad[0], good[1] + bad[1], b"a", b"letter xxx " * 30_000):
        want = (size(raw, dictionaries[1]) - size(raw, dictionaries[0])) / len(raw)
        assert pair.difference(raw.decode()) == pytest.approx(want, abs=2e-3 + 2 / len(raw))
    assert pair.difference(good[2].decode()) > 0 > pair.difference(bad[2].decode())
    assert pair.difference(None) == pair.difference("") == 0.0
    # at the fitted curve the sum of the errors is 0, and that of the errors times x but for the ridge
    x = np.r_[rng.normal(1, 1, 400), rng.normal(-1, 1, 300)]
    is_good = np.r_[np.ones(400), np.zeros(300)]
    a, b = compression_quality.logistic(x, is_good)
    error = is_good - 1 / (1 + np.exp(-(a + b * x)))
    assert abs(error.sum()) < 1e-3 and abs((error * x).sum()) < 0.1 and b > 0


def test_compression_scores(spark, real, docs, no_docs, labels):
    out = {r["doc_id"]: r for r in compression_quality.score(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"),
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()}
    held = [r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if fold(r["doc_id"])]
    good = [out[r["doc_id"]]["predicted"] for r in held if r["quality"]]
    bad = [out[r["doc_id"]]["predicted"] for r in held if not r["quality"]]
    assert sum(good) >= 0.85 * len(good) and sum(bad) <= 0.3 * len(bad)
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        few = compression_quality.score(docs, known, "doc_id").collect()
        assert len(few) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in few)
    assert compression_quality.score(no_docs, labels, "doc_id").count() == 0


def test_license_rules(spark, docs, no_docs):
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in "
              "compliance\nwith the License.")
    texts = [(1, f"Some text. {apache} More."), (2, "x\nReleased under the MIT License.\ny. Released under the MIT License"),
             (3, None), (4, ""), (5, "no licence here"), (6, LONG + "\nLicensed under CC BY-NC 4.0.\nEnd"),
             (7, "We talk of the Apache License, Version 2.0 at length.")]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as license", "2 as start")
    out = [(r["doc_id"], r["license"], dict(texts)[r["doc_id"]][r["start"]:r["end"]])
           for r in license_rules.scan(df).orderBy("doc_id", "start").collect()]
    assert out == [(1, "Apache-2.0", apache), (2, "MIT", "Released under the MIT License."),
                   (2, "MIT", "Released under the MIT License"), (6, "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.")]
    assert license_rules.scan(docs).count() == 0 and license_rules.scan(no_docs).count() == 0


GPL = ("This program is free software{0} you can redistribute it and/or modify\nit under the terms of the GNU {1}General Public "
       "License as published by\nthe Free Software Foundation{2} either version {3} of the License, or\n(at your option) any later "
       "version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the "
       "implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.")
BSD = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following "
       "conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions "
       "and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of "
       "conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n{0}"
       "THIS SOFTWARE IS PROVIDED BY THE {1} \"AS IS\"\nAND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE\n"
       "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE\nDISCLAIMED.{2}")
BSD_LIABLE = ("IN NO EVENT SHALL THE {} BE LIABLE FOR ANY DIRECT, INDIRECT,\nINCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
              "(INCLUDING, BUT NOT\nLIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,\nOR PROFITS; OR BUSINESS "
              "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF\nLIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
              "NEGLIGENCE\nOR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF\nADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
OWNERS = "COPYRIGHT HOLDERS AND CONTRIBUTORS"
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance "
     "with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by "
     "applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions "
     "and\nlimitations under the License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
     "files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, "
     "modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software "
     "is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
     "included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
     "KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND "
     "NONINFRINGEMENT. IN NO EVENT SHALL THE\nAUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER "
     "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,\nOUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
     "IN THE\nSOFTWARE."),
    ("GPL-3.0-or-later", GPL.format(":", "", ",", "3")), ("GPL-2.0-or-later", GPL.format(";", "", ";", "2")),
    ("LGPL-2.1-or-later", GPL.format(";", "Lesser ", ";", "2.1").replace("program", "library")),
    ("LGPL-3.0-or-later", GPL.format(":", "Lesser ", ",", "3")), ("AGPL-3.0-or-later", GPL.format(":", "Affero ", ",", "3")),
    ("BSD-2-Clause", BSD.format("", OWNERS, " " + BSD_LIABLE.format("COPYRIGHT HOLDER OR CONTRIBUTORS"))),
    ("BSD-3-Clause", BSD.format("3. Neither the name of the University nor the names of its contributors may be used to\n   endorse or "
                                "promote products derived from this software without\n   specific prior written permission.\n\n",
                                "REGENTS", " " + BSD_LIABLE.format("REGENTS"))),
    ("BSD", BSD.format("3. All advertising materials mentioning features or use of this software must display the following "
                       "acknowledgement:\n   This product includes software developed by X.\n4. The name of X may not be used.\n\n",
                       OWNERS, "")),
    ("GPL-2.0-only", GPL.format(";", "", "", "2").replace(" as published by\nthe Free Software Foundation either version 2 of the "
                                                          "License, or\n(at your option) any later version",
                                                          " version 2 as\npublished by the Free Software Foundation")),
    ("LGPL-3.0-only", GPL.format(":", "Lesser ", ",", "3").replace("either version", "version")
     .replace(" of the License, or\n(at your option) any later version", " of the License")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
     "distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, "
     "provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND "
     "THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, "
     "use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial "
     "or non-commercial, and by any\nmeans."),
    *[(name, text) for name, text in (
        ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("MIT", "Licensed under the MIT license."),
        ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
        ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Released under CC0 1.0."))],
]


@pytest.mark.parametrize("licence, notice", NOTICES)
def test_standard_notices_are_found_whole(licence, notice):
    scanner = license_rules.Scanner()
    forms = {"plain": notice, "one line": " ".join(notice.split()) if licence != "Apache-2.0" else notice.replace("\n\n", "\n")}
    forms |= {mark: "\n".join((mark + line).rstrip() for line in notice.split("\n")) for mark in ("# ", " * ", "// ")}
    for form, text in forms.items():
        for before, after in (("", ""), ("A file.\nCopyright (C) 2020 A. Writer\n\n", "\n\nint main;\n"), ("Copyright 2020\n", "\nx")):
            found = scanner.scan(before + text + after)
            assert [f[0] for f in found] == [licence], (form, found)
            assert (before + text + after)[found[0][2]:found[0][3]] == text.strip(), form


NAMED = [
    ("SPDX-License-Identifier: MIT", ["MIT"]), ("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR 0BSD */",
                                                ["GPL-2.0-only", "0BSD"]),
    ("This program is licensed under the MIT License.", ["MIT"]), ("Licensed under GPLv3.", ["GPL-3.0-only"]),
    ("Released under the Apache 2.0 license.", ["Apache-2.0"]), ("dual licensed under MIT / Apache-2.0", ["MIT", "Apache-2.0"]),
    ("Licensed under the Apache License, Version 2.0 and MIT.", ["Apache-2.0", "MIT"]),
    ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]), ("released under the zlib licence", ["Zlib"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike\n4.0 International License.",
     ["CC-BY-NC-SA-4.0"]), ("licensed under a Creative Commons Attribution 4.0 International License", ["CC-BY-4.0"]),
    ("released under the terms of the GNU General Public License version 2.", ["GPL-2.0-only"]),
    ("distributed under the GPL v2 or (at your option) any later version", ["GPL-2.0-or-later"]),
    ("available under LGPL-2.1+", ["LGPL-2.1-or-later"]), ("subject to the terms of the Eclipse Public License 2.0", ["EPL-2.0"]),
    ("licensed under the EUPL v1.2", ["EUPL-1.2"]), ("licensed under\n# the MPL 2.0.", ["MPL-2.0"]),
    ("x\nLicense: BSD 3-Clause\ny", ["BSD-3-Clause"]), ("covered by a BSD-style license", ["BSD"]),
    ("licensed under the GPL. 2 cats", ["GPL"]),
    # a name alone, a verb alone, a word that begins like a name
    ("We talk of the Apache License, Version 2.0 at length.", []), ("subject to change", []),
    ("He was released under the mitigating rules, covered by iscariot.", []), ("licensed under. The MIT", []),
]


@pytest.mark.parametrize("text, licences", NAMED)
def test_named_licences(text, licences):
    scanner = license_rules.Scanner()
    for before, after in (("", ""), ("Some words.\n", "\nMore words."), ("é" * 50 + " \n", "\n")):
        found = scanner.scan(before + text + after)
        assert [f[0] for f in found] == licences
        assert all(len(before) <= a < b <= len(before + text) for *_, a, b in found)


def test_long_runs_between_words_of_a_name_are_read_once():
    blank = " " * 200_000
    assert license_rules.Scanner().scan(f"licensed under{blank}the MIT{blank}license{blank}version{blank}") [0][0] == "MIT"
    assert license_rules.Scanner().scan(f"licensed under{blank}the " * 3) == []


def test_licenses_equal_a_pattern_search(real):
    fixed = {"MIT": "Released under the MIT License", "Apache-2.0": "Licensed under the Apache License, Version 2\\.0",
             "CC-BY-NC-4.0": "Licensed under CC BY-NC 4\\.0",
             "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3"}
    want = sorted((r["doc_id"], k) for r in real["documents"].collect() for k, p in fixed.items()
                  for _ in re.finditer(p, r["text"] or ""))
    assert want == sorted((r["doc_id"], r["license"]) for r in license_rules.scan(real["documents"]).collect())
