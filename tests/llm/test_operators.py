"""Every operator against its SQL twin or brute force on hand-made tables."""

from __future__ import annotations

import collections
import functools
import hashlib
import itertools
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from profilespark.llm import exact_dedup, fill_in_middle, filter_audit, fingerprints, language_id, licenses, line_dedup, mixing, near_dedup, packing, quality_rules, shingles, token_counts, warc
from profilespark.llm.queries import ORACLES, QUERIES
from profilespark.llm.tokens import WordIds
from profilespark.session import materialize
from tests.llm.tables import changed, documents, frame, odd_rows, prose
from tests.oracle_check import compare

DOCUMENT_QUERIES = sorted(n for n in QUERIES if n != "op8_warc")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+").findall


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables written from rows, as queries read them."""
    def write(rows, clashing=False, pages=()):
        path = str(tmp_path_factory.mktemp("tables"))
        frame(spark, rows, clashing).repartition(3).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(list(pages), "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
        labels = [(r[0], r[0] % 2, r[0] % 3 // 2) for r in rows if r[0] is not None and r[0] % 5] + [(None, 1, 1), (3, None, 1)] * bool(rows)
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        return path
    return write


@pytest.fixture(scope="module")
def usual(folder):
    big = "<p>" + "x" * 2000
    pages = [(1, "u1", big), (2, "u 2\n", big), (3, None, big), (4, "u4", "small"), (5, "u5", "small"), (6, "u6", None), (7, "u7", ""), (8, "u8", "é" * 600), (9, "u9", "é" * 600)]
    return folder(documents(), clashing=True, pages=pages)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql_on_hand_made_tables(name, spark, usual):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{usual}/{t}.parquet/*.parquet'")
    assert compare(QUERIES[name](spark, usual), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(name, spark, folder):
    assert QUERIES[name](spark, folder([])).collect() == []


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_null_and_repeated_rows_give_a_row_each(name, spark, folder):
    result = QUERIES[name](spark, folder(odd_rows(), clashing=True))
    if name == "op5_token_counts":
        assert result.where("tokenizer = 'words-1'").agg(F.sum("n_docs")).first()[0] == len(odd_rows())
    elif name == "op9_packing":
        assert result.where("start = 0").count() == len(odd_rows())
    elif name == "op13_filter_audit":
        rows = result.collect()
        parts = collections.Counter(r[3] or "" for r in odd_rows())
        assert len(rows) == 600 * len(parts)
        assert all(r.kept + sum(x.removed for x in rows if (x.part, x.filter_order) == (r.part, r.filter_order)) == parts[r.part] for r in rows if r.step == 5)
    else:
        assert collections.Counter(r["doc_id"] for r in result.collect()) == collections.Counter(r[0] for r in odd_rows())


# Licenses


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    hits = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_license_base_places(spark, folder):
    rows = [*documents(), (900, "mit license, MIT-License; the mitt license. apache\n\n  LICENSE cc by-sa CC.BY ccby", "en", "s", 1),
            (901, "Licensed under the Apache License, Version 2.0 and the GNU General Public License v3 or MIT license " * 50, "en", "s", 1)]
    got = {r.doc_id: r for r in QUERIES["op1_license_scan"](spark, folder(rows)).collect()}
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_suppression_is_by_priority_and_containment():
    scan = licenses.Scanner().scan
    kept = lambda text: {d.label for d in scan(text)[1] if not d.suppressed}
    assert kept("Licensed under the Apache License, Version 2.0") == {"apache", "apache-2.0"}
    assert kept("SPDX-License-Identifier: GPL-2.0-or-later") == {"gpl-2.0-or-later"}
    assert kept("Creative Commons Attribution-ShareAlike 4.0") == {"cc-by-sa-4.0"}
    assert kept("nothing of the kind") == set()
    found = [licenses.Detection(*x) for x in (("a", 0, 10, 5, False), ("b", 2, 8, 9, False), ("c", 3, 7, 1, False), ("d", 5, 12, 5, False), ("e", 0, 10, 5, False), ("f", 3, 7, 1, True))]
    licenses.resolve(found)
    assert [d.label for d in found if d.suppressed] == ["c", "e"]


@pytest.mark.parametrize("gap", ["," + " " * 35 + "*\n * ", " " * 500, "\n" + "-" * 78 + "\n", "\u00a0", "\u2011", " " * 200_000])
def test_rules_read_any_gap_between_words(gap):
    scan = licenses.Scanner().scan
    for text, label in (("Licensed under the Apache License Version 2.0", "apache-2.0"), ("SPDX-License-Identifier: MIT", "mit"),
                        ("universal permissive license (UPL) 1.0", "upl-1.0")):
        found = [d for d in scan(re.sub("[ -]", lambda m: gap, text))[1] if not d.suppressed]
        assert label in {d.label for d in found}


def test_suppression_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        found = [licenses.Detection(str(i), int(s), int(s + n), int(p), False) for i, (s, n, p) in enumerate(zip(rng.integers(0, 30, 25), rng.integers(1, 15, 25), rng.integers(1, 4, 25)))]
        licenses.resolve(found)
        kept = []
        for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.label)):
            inside = any(k.start <= d.start and d.end <= k.end for k in kept)
            assert d.suppressed == inside
            kept += [] if inside else [d]


# Exact dedup


@pytest.mark.parametrize("bits,page_bytes,depth", [(64, 1 << 18, 18), (2, 4096, 4), (1, 512, 0), (64, 256, 6)])
def test_index_with_forced_collisions_and_pages(spark, bits, page_bytes, depth):
    rows = [(i, f"text {i % 37} {'y' * (i % 5)}" + " " * (i % 3), None, None, 0) for i in range(600)]
    index = exact_dedup.build_index(frame(spark, rows), page_bytes=page_bytes, max_depth=depth, key_bits=bits)
    got = {r["id"]: r for r in exact_dedup.classes(index).collect()}
    groups = collections.defaultdict(list)
    for i, text, *_ in rows:
        groups["".join(text.split())].append((-len(text), i))
    for members in groups.values():
        for _, i in members:
            assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (min(members)[1], len(members), i == min(members)[1])


def test_directory_splits_overfull_buckets_only(spark):
    rows = exact_dedup.keyed(frame(spark, [(i, f"{i}" * 50, None, None, 0) for i in range(2000)] + [(i, "same", None, None, 0) for i in range(3000, 4000)]))
    cells = exact_dedup.directory(rows, page_bytes=8192, max_depth=10).toPandas()
    assert cells["bucket"].le(cells["cell"]).all() and cells["bucket"].nunique() > 10
    hot = rows.where("bare = 'same'").select(F.shiftrightunsigned("key", 54).cast("int")).first()[0]
    assert cells.set_index("cell")["pages"][hot] > 5 and (cells["pages"] > 1).sum() <= 3


def test_one_of_equal_rows_is_kept(spark):
    rows = [(5, "a b", "x", "s", 1), (5, "ab ", "y", "s", 1), (5, "ab ", "y", "s", 1), (None, "ab", "z", "s", 1)]
    got = exact_dedup.exact_dedup(frame(spark, rows, clashing=True))
    assert [(r.doc_id, len(r.text)) for r in got.collect()] == [(5, 3)] and "row" in got.columns


# Near-dedup


def brute_classes(rows):
    sets, parent = {}, {}
    for i, text, *_ in rows:
        _, h, n, _ = shingles.shingles([text or ""])
        sets[i], parent[i] = (h, n), i
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and len(sets[x][0]) and shingles.similarity(sets[x], sets[y]) >= near_dedup.MIN_SIMILARITY:
                low, high = sorted((find(x), find(y)))
                parent[high] = low
    return {i: find(i) for i in ids}


def test_near_classes_against_brute_force(spark):
    base = [prose("en", 150, 1000 + i) for i in range(6)]
    rows = documents() + [(1000 + 10 * i + j, changed_at(base[i], j), "en", "s", 0) for i in range(6) for j in range(8)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(frame(spark, rows, clashing=True)).collect()}
    assert got == brute_classes(rows)
    assert len(set(got.values())) < len(rows) - 20


def changed_at(text, j):
    words = text.split(" ")
    for k in range(min(j, 5)):
        words[(17 * j + 31 * k) % len(words)] = f"other{j}x{k}"
    return " ".join(words)


def test_a_large_group_of_near_copies_is_one_class(spark):
    base = prose("en", 200, 5)
    rows = [(i, changed_at(base, 1 + i % 5).replace("other", f"other{i}"), "en", "s", 0) for i in range(400)] + [(1000 + i, prose("en", 120, 50 + i), "en", "s", 0) for i in range(50)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_sketches_agree_as_often_as_weighted_sets_are_similar():
    texts = ["a b c d e f g h i j " * 3 + prose("en", 200, 1), "a b c d e f g h i j " * 9 + prose("en", 200, 1), prose("en", 200, 2), "one two", ""]
    owner, element, weight, counts = shingles.shingles(texts)
    ids = near_dedup.dart_minhash.sketch(owner, element, weight, len(texts), 4000)
    sets = [(element[owner == i], weight[owner == i]) for i in range(len(texts))]
    for i in range(3):
        for j in range(i):
            assert abs((ids[i] == ids[j]).mean() - shingles.similarity(sets[i], sets[j])) < 0.04
    assert not ids[4].any() and (ids[:4] != 0).all() and counts.tolist()[3:] == [2, 0]


def test_shingles_against_a_plain_count():
    for text in ("a b c d e a b c d e f", "x", "", "One, two; THREE four!", "a a a a a a a a"):
        words = re.findall(r"[^\W_]+", text.lower())
        plain = collections.Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else {}
        _, _, weight, counts = shingles.shingles([text])
        assert sorted(weight) == sorted(plain.values()) and counts[0] == len(words)


# Quality rules


def test_distance_rejects_what_no_language_looks_like(spark):
    rows = [(i, prose("en", 120, i), "en", "s", 0) for i in range(80)] + [(500, "#### %%% " * 60 + prose("en", 5, 1), "en", "s", 0), (501, "#### %%% " * 10, "en", "s", 0)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(frame(spark, rows, clashing=True)).collect()}
    assert all(got[i].kept for i in range(80))
    assert got[500].char_distance > quality_rules.MAX_CHAR_DISTANCE and got[501].char_distance is None


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_a_language_is_judged_however_large_the_others_are(spark, monkeypatch, broadcast):
    monkeypatch.setattr(quality_rules, "REFERENCE_WORDS", 100)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    small = [(i, prose("de", 60, i), "de", "s", 0) for i in range(5)] + [(500, "#### %%% " * 60, "de", "s", 0)]
    large = [(1000 + i, prose("en", 5000, i), "en", "s", 0) for i in range(100)]
    try:
        alone, beside = ({r.doc_id: r for r in quality_rules.quality_rules(frame(spark, rows)).collect()} for rows in (small, small + large))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all(beside[r[0]] == alone[r[0]] for r in small)
    assert beside[500].char_distance > quality_rules.MAX_CHAR_DISTANCE and not beside[500].kept


# Token counts


def test_rollup_by_signed_changes(spark):
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, source string, lang string, tokenizer string, n_tokens long")
    rollup = token_counts.TokenRollup(spark)
    total = lambda: {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}
    assert total() == {}
    first = make([(1, "a", "en", "t1", 10), (2, "a", None, "t1", 5), (3, None, "en", "t1", 7), (1, "a", "en", "t2", 20), (None, "a", "en", "t1", 1)])
    assert rollup.commit("b1", inserts=first) and not rollup.commit("b1", inserts=first)
    assert total() == {("a", "en", "t1"): (2, 11), ("a", None, "t1"): (1, 5), (None, "en", "t1"): (1, 7), ("a", "en", "t2"): (1, 20)}
    changes = dict(deletes=make([(2, "", "", "", 0)]).select("doc_id"), revised=make([(1, "b", "en", "t1", 12), (9, "c", "en", "t1", 4)]))
    assert rollup.commit("b2", **changes) and not rollup.commit("b2", **changes)
    assert total() == {("a", "en", "t1"): (1, 1), (None, "en", "t1"): (1, 7), ("a", "en", "t2"): (1, 20), ("b", "en", "t1"): (1, 12), ("c", "en", "t1"): (1, 4)}
    # An interrupted batch has a ledger but no marker: it is not read, and replaces its files when it comes again.
    make([(77, "z", "en", "t1", 1)]).selectExpr("doc_id", "source", "lang", "tokenizer", "1L AS n_docs", "n_tokens").write.parquet(f"{rollup.folder}/ledger/b3")
    assert ("z", "en", "t1") not in total()
    assert rollup.commit("b3", deletes=make([(1, "", "", "", 0)]).select("doc_id"))
    assert total() == {("a", "en", "t1"): (1, 1), (None, "en", "t1"): (1, 7), ("c", "en", "t1"): (1, 4)}


def test_token_totals_against_the_library(spark, usual):
    whole = WordIds().whole
    want = collections.Counter()
    for _, text, lang, source, _ in documents():
        want[source, lang, token_counts.WORDS] += len(SPLIT(text or ""))
        want[source, lang, token_counts.WORD_BPE_49K] += len(whole.encode(text or "", add_special_tokens=False).ids)
    got = {(r.source, r.lang, r.tokenizer): r.n_tokens for r in QUERIES["op5_token_counts"](spark, usual).collect()}
    assert got == dict(want)


# Language identification


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op6_language_id"](spark, sf_dir).join(docs, "doc_id")
    out = got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert out[0] >= 0.95 and out[1] > 30
    assert got.where("held_out <> (crc32(cast(doc_id AS string)) % 4 = 2)").count() == 0


def test_labels_are_no_input_of_a_prediction(spark):
    rows = [(i, prose("en" if i % 2 else "de", 60, i), "en" if i % 2 else "de", "s", 0) for i in range(60)]
    model = language_id.learn_languages(frame(spark, rows))
    asked = spark.createDataFrame([(1, prose("de", 50, 999)), (2, prose("en", 50, 998)), (3, None), (4, "123 !"), (5, "漢字")], "k int, text string")
    got = {r.row.k: r for r in language_id.identify(asked.select(F.struct("k").alias("row"), "text"), model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 4)] == ["de", "en", "und", "und"] and got[3].score == 0
    assert got[5].lang_pred in ("de", "en") and all(0 <= r.score <= 1 for r in got.values())


def test_a_language_is_learnt_however_few_documents_name_it(spark):
    rows = [(i, prose("en", 12, i % 50), "en", "src0", 1) for i in range(3000)]
    rows += [(5000, "αυτό είναι ένα κείμενο για το σπίτι και τη θάλασσα", "el", "src0", 1)]
    rows += [(6000 + i, prose("de", 30, i), f"{i:03}-xx", "src0", 1) for i in range(70)]
    model = language_id.learn_languages(frame(spark, rows))
    assert model.languages == (*(f"{i:03}-xx" for i in range(70)), "el", "en")
    langs, scores = model.predict(["ένα σπίτι και ένα κείμενο", "the house and the river"])
    assert langs == ["el", "en"] and min(scores) > 0.5


def test_grams_and_filters_against_plain_sets():
    texts = ["Ab cd, éfg", "", "x", "don't"]
    h, owner = language_id.grams(texts)
    def plain(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        return [f" {w} "[i:i + n] for w in words for n in (3, 4) for i in range(len(w) + 3 - n)]
    assert np.bincount(owner, minlength=4).tolist() == [len(plain(t)) for t in texts]
    assert len(set(h[owner == 0].tolist())) == len(set(plain(texts[0])))
    planes = np.zeros((2, 1 << language_id.SLOT_BITS), np.uint64)
    for slot in language_id.slots_of(h[owner == 0]):
        planes[1, slot] |= np.uint64(1) << np.uint64(3)
    model = language_id.LanguageFilter(tuple(f"l{i:02d}" for i in range(70)), planes)
    assert model.predict(["ab cd", "zzz qqq"])[0][0] == "l67" and model.predict(["cd"])[1][0] > 0.99


def test_very_long_text_is_read_in_segments(monkeypatch):
    text = prose("en", 3000, 4)
    whole = language_id.grams([text])[0]
    monkeypatch.setattr(language_id, "SEGMENT", 500)
    parts = [language_id.grams(block)[0] for _, block in language_id._blocks([text])]
    assert len(parts) > 20 and sorted(np.concatenate(parts).tolist()) == sorted(whole.tolist())


# Quality rules


def test_a_small_language_beside_a_large_one(spark, folder):
    """A language below a thousandth of all words, and one of more than half: both are references, as the SQL says."""
    rows = [(i, prose("en", 20_000, i), "en", "s", 0) for i in range(260)] + [(1000 + i, prose("de", 1_100, i), "de", "s", 0) for i in range(5)]
    rows += [(2000, "1234 %%%% " * 200, "de", "s", 0), (2001, prose("en", 400, 9), "de", "s", 0), (2002, prose("de", 60, 9), "xx", "s", 0)]
    path = folder(rows)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
    assert compare(QUERIES["op4_quality_rules"](spark, path), con, ORACLES["op4_quality_rules"]) is None
    judged = {r.doc_id: r for r in QUERIES["op4_quality_rules"](spark, path).where("doc_id >= 1000").collect()}
    assert judged[2001].word_distance > judged[1000].word_distance and judged[2000].char_distance > 0.3 and judged[2002].word_distance is None


def _wordy(spark):
    """Languages with common words among rare ones, each once; cases, a null text and lang, an empty text and rows that come twice."""
    rows = [(i, " ".join(f"The the {k}w{i} Of\t" for k in range(100)), "en", "s", 0) for i in range(100)]
    rows += [(200 + i, "ÉTÉ été " * 4 + " ".join(f"r{k}x{i}" for k in range(1992)), None, "s", 0) for i in range(3)]  # 8 of 2,000: above 1/500
    rows += [(300 + i, "just " * 2 + " ".join(f"q{k}x{i}" for k in range(998)), "at", "s", 0) for i in range(6)]  # 1/500 exactly
    rows += [(400 + i, "under " + " ".join(f"u{k}x{i}" for k in range(998)), "no", "s", 0) for i in range(6)]
    rows += [(500, "few words", "xx", "s", 0), (501, None, "en", "s", 0), (502, "", None, "s", 0), (503, "hot " * 6000, "", "s", 0)]
    return rows + rows[:7] + rows[-4:]


def test_rare_words_are_not_shuffled(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(quality_rules, "materialize", lambda df, name: written.setdefault(name, materialize(df, name)))
    quality_rules.common_words(frame(spark, _wordy(spark)))
    assert 0 < written["vocabulary"].count() < 1500  # of 28,000 different words


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_common_words_do_not_depend_on_buckets(spark, monkeypatch, buckets):
    monkeypatch.setattr(quality_rules, "BUCKETS", buckets, raising=False)
    rows = _wordy(spark)
    found = {None if r.no_lang else r.language: r for r in quality_rules.common_words(frame(spark, rows)).collect()}
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang, *_ in rows:
        counts[lang].update((text or "").lower().split())
    plain = {}
    for lang, n in counts.items():
        if sum(n.values()) >= quality_rules.REFERENCE_WORDS and (listed := sorted(w for w in n if n[w] * 500 >= sum(n.values()))):
            plain[lang] = (listed, [n[w] for w in listed], sum(n.values()))
    assert sorted(map(str, plain)) == ["", "None", "at", "en"] and plain["en"][0] == ["of", "the"] and plain["at"][0] == ["just"]
    assert {k: (r.common, r.word_counts[:-1], r.word_total) for k, r in found.items()} == plain
    assert all(sum(r.word_counts) == r.word_total for r in found.values())
    assert quality_rules.common_words(frame(spark, rows[:0])).count() == 0


# Line dedup


def test_runs_do_not_depend_on_batches(spark):
    docs = frame(spark, documents())
    lines = line_dedup.long_lines(docs)
    totals = []
    for n, fan_out in ((1, 3), (5, 2), (7, 3)):
        runs = line_dedup.LineRuns(spark, buckets=4, fan_out=fan_out)
        for k in range(n):
            runs.add(lines.where(F.col("doc_id") % n == k))
        assert max(len(level) for level in runs.levels) < fan_out
        totals.append(rows_of(runs.totals().select("hash_1", "hash_2", "n_docs", "max_doc")))
        assert runs.totals().where("not first").count() == 0
        assert sum(run.where("first").count() for run in runs.runs) == len(totals[0])
    assert totals[0] == totals[1] == totals[2]


def brute_lines(rows, min_docs=5):
    """Kept texts: a long line that enough rows hold stays only where the doc_id is the largest that holds it."""
    key = lambda x: x.translate({i: i + 32 for i in range(65, 91)}).strip(" \t\n\x0b\x0c\r")
    holders = collections.defaultdict(list)
    for i, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(i)
    common = {k: max((i for i in h if i is not None), default=None) for k, h in holders.items() if len(k) >= 40 and len(h) >= min_docs}
    stays = lambda i, x: (k := key(x)) not in common or common[k] is None or i == common[k]
    return [(i, "\n".join(x for x in (text or "").split("\n") if stays(i, x))) for i, text, *_ in rows]


def test_lines_of_long_documents_and_shared_ids(spark):
    """Documents of many common lines, null and shared doc_ids with different texts, against brute force."""
    lines = [f"This is line number {n:06d} of a listing that many documents hold" for n in range(3000)]
    rows = [(k, "\n".join([f"own {k}", *lines[k:], "short", lines[0]]), None, None, 0) for k in range(6)]
    rows += [(None, "\n".join(lines[:9]), None, None, 0), (None, lines[3], None, None, 0), (2, "\n".join(["x", lines[5], "", lines[5]]), None, None, 0), (2, "", None, None, 0)]
    docs = frame(spark, rows)
    held, parts = line_dedup.batches(docs, 3)
    runs = line_dedup.LineRuns(spark, buckets=4)
    for part in parts:
        runs.add(part)
    got = collections.Counter((r.doc_id, r.kept_text) for r in line_dedup.dedup_lines(docs, held, runs).collect())
    assert got == collections.Counter(brute_lines(rows))


# WARC


def test_pages_against_their_records(spark, usual):
    index = warc.write_archives(spark.read.parquet(f"{usual}/pages.parquet"))
    records = {r.page_id: r for r in warc.read_records(index).collect()}
    pages = {r.page_id: r for r in spark.read.parquet(f"{usual}/pages.parquet").collect()}
    assert all(bytes(records[i].payload) == (p.html or "").encode() for i, p in pages.items() if records[i].record_type == "response")
    assert records[2].url is not None and records[3].url is None and records[1].refers_to == 3 and records[3].record_type == "response"
    some = warc.read_records(index.where("page_id in (4, 8)"))
    assert sorted(r.page_id for r in some.collect()) == [4, 8]


def test_pages_with_nulls_and_ties(spark):
    big = "y" * 1500
    rows = [(None, None, big), (3, "a", big), (3, "b", big), (2, "c", big), (None, "d", None)]
    got = warc.read_records(warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert sorted(((r.page_id, r.record_type, r.refers_to) for r in got.collect()), key=repr) == sorted(
        [(None, "revisit", 3), (3, "response", None), (3, "response", None), (2, "revisit", 3), (None, "response", None)], key=repr)


def test_ranges_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 200_000, 5), ("b", 200_005, 5), ("b", 200_010, warc.READ_BYTES), ("b", 200_010 + warc.READ_BYTES, 1)]
    assert [len(m) for _, m in warc._ranges(iter(rows))] == [2, 1, 1, 1, 1]


# Packing


def check_pieces(pieces, texts):
    ids = WordIds().whole
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc_id, text in texts.items():
        own, at = [*ids.encode(text or "", add_special_tokens=False).ids, 1], 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(own) and p.ids_crc32 == zlib.crc32(np.array(own[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(own)
    filled = []
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= packing.WINDOW
        filled.append(at)
    return filled


def test_pieces_hold_every_id_once(spark, usual):
    filled = check_pieces(QUERIES["op9_packing"](spark, usual).collect(), {r[0]: r[1] for r in documents()})
    assert sum(filled) / (len(filled) * packing.WINDOW) > 0.8


def test_padding_is_little(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    filled = check_pieces(packing.pack(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert sum(filled) / (len(filled) * packing.WINDOW) > 0.97


def test_long_texts_and_chunks_are_packed_whole(spark):
    """Texts of many windows, texts that fill their last one, and chunks too long to be remembered, in few groups."""
    texts = {0: "alpha beta " * 4000, 1: "x" * 5000 + " y", 2: "word " * (packing.WINDOW - 1), 3: "QUJD/+=" * 900, 4: "", 5: "one " * 3000}
    texts |= {i: f"short text {i} " + "filler " * (i % 40) for i in range(6, 60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    check_pieces(packing.pack(docs, group=8, remembered=30).collect(), texts)


def test_differencing_balances_and_raises_the_count():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 700):
        sizes = rng.integers(1, 513, n)
        window, k = packing.balanced_windows(sizes, 2048)
        sums = np.bincount(window, weights=sizes, minlength=k)
        assert (sums <= 2048).all() and k >= -(-int(sizes.sum()) // 2048)
        if n == 700:
            assert np.ptp(sums) < 200 and k <= 1.06 * sizes.sum() / 2048
    window, k = packing.balanced_windows(np.array([1500, 1500, 1000]), 2048)
    assert k == 3 and len(set(window)) == 3
    assert np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4]).tolist() in ([14, 16], [16, 14])


def test_remembered_chunks_stay_bounded():
    small = WordIds(remembered=50)
    texts = [prose("en", 80, i) + " It's “quoted” №5 \x1c ＡＢ <|endoftext|> é İ ΣΑΣ" for i in range(20)]
    assert small(texts) == [np.array(small.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert len(small.chunks) <= 400


def test_new_pieces_reach_the_tokenizer_many_at_a_time():
    class Counted:
        def __init__(self, inner):
            self.inner, self.texts = inner, 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return self.inner.encode_batch_fast(texts, **options)

    texts = [" ".join(f"w{a}{b}ä{c}." for b in "abcdefghij" for c in "klmnopqrst") for a in "abcdefghij"]
    texts += ["", " \u2003 ", "\x85a\u2028</w> < / w >", "a\x1cb </w>"]
    own, unmarked = WordIds(), WordIds()
    own.bare = Counted(own.bare)
    want = [np.array(own.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own(texts) == want and own.bare.texts <= 10
    assert own(pa.array(["x", *texts]).slice(1)) == want and own([]) == []
    unmarked.last[:] = False  # as a vocabulary that does not tell where a piece ends
    assert unmarked(texts) == want


# Mixing


def test_targets_against_resharing(spark):
    rng = np.random.default_rng(2)
    for _ in range(4):
        sizes = {f"s{i}": int(x) for i, x in enumerate(rng.integers(0, 100, 9) ** 3)}
        table = spark.createDataFrame([(False, s, n) for s, n in sizes.items()], "no_source boolean, source_name string, source_size long")
        got = {r.source_name: r.target for r in mixing.source_targets(table).collect()}
        weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes))}
        want, total, capped = {}, sum(sizes.values()), set()
        while True:
            left = total - sum(3 * sizes[s] for s in capped)
            share = sum(w for s, w in weight.items() if s not in capped)
            want = {s: 3.0 * sizes[s] if s in capped else left * weight[s] / share for s in sizes}
            over = {s for s in sizes if s not in capped and want[s] > 3 * sizes[s]}
            if not over:
                break
            capped |= over
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, total) for s in sizes)


def test_taken_words_come_near_their_targets(spark, sf_dir):
    got = QUERIES["op10_mixing"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    sums = got.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"))
    assert all(abs(r.taken - r.target) <= r.most + 1 for r in sums.collect())
    assert got.where("taken > 3 * size").count() == 0
    assert rows_of(got) == rows_of(QUERIES["op10_mixing"](spark, sf_dir))


def test_mix_emits_copies(spark):
    rows = [(i, "w " * (1 + i % 7), None, "a" if i < 300 else "b", 0) for i in range(330)]
    docs = frame(spark, rows, clashing=True)
    taken = {r.row.doc_id: r.copies for r in mixing.mixing_copies(docs.select("doc_id", "text", "source")).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = collections.Counter(r.doc_id for r in mixed.collect())
    assert counts == {k: v for k, v in taken.items() if v} and max(counts.values()) == 3




# Fill in the middle


MARKED = [(900, "a <P> b c d", None, "s", 1), (901, "<M>", None, "s", 1), (902, "x <S y P> <", None, "s", 1), (903, " \t\n\x0b\x0c\r", None, "s", 1),
          (904, "\u00a0a\u2003b \u00e9 \U0001f600\x85z\x1c", None, "s", 1), (905, " lead and trail \n", None, "s", 1), (906, "w " * 400_000, None, "s", 1)]


def brute_fim(doc_id, text, rate=50):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate", [50, 100])
def test_fill_in_middle_against_brute_force_and_back(spark, rate):
    rows = [*odd_rows(), *MARKED]
    out = fill_in_middle.fill_in_middle(frame(spark, rows, clashing=True), rate=rate)
    out = out.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form")))
    want = sorted((repr((i, *brute_fim(i, text, rate), text or "")) for i, text, *_ in rows))
    assert sorted(repr(tuple(r)) for r in out.collect()) == want
    assert rate < 100 or {r.form for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_units_are_dealt_in_batches_of_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (3, 5, 20, 1, 1, 9, 0)])], names=["text"])
    assert [b.num_rows for b in fill_in_middle.by_bytes([batch], most=10)] == [2, 1, 2, 2]


# Fingerprints


def brute_bins(text):
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in SPLIT(text.lower())]
    chain = lambda run, h=42: functools.reduce(lambda a, w: xxhash.xxh64_intdigest(w.to_bytes(8, "little"), a), run, h)
    if not words:
        return None
    if len(words) < 5:
        hashes = [functools.reduce(lambda a, w: xxhash.xxh64_intdigest(w.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)), words, 42)]
    else:
        hashes = [chain(words[i:i + 5]) for i in range(len(words) - 4)]
    least = {}
    for h in hashes:
        signed = h - 2**64 if h >= 2**63 else h
        b = (signed >> (64 - fingerprints.BIN_BITS)) + fingerprints.BINS // 2
        least[b] = min(least.get(b, signed), signed)
    out = []
    for j in range(fingerprints.BINS):
        at = next(b for b in [j, *((fingerprints.START[j] + fingerprints.STEP[j] * t) % fingerprints.PRIME for t in range(fingerprints.PRIME))] if b in least)
        out.append(least[at] & 15)
    return out


def brute_likeness(a, b):
    if a is None or b is None:
        return float(a is b)
    return max(0.0, (sum(x == y for x, y in zip(a, b)) / len(a) - 1 / 16) / (1 - 1 / 16))


@pytest.mark.parametrize("rows_a_bucket", [2048, 5])
def test_fingerprints_against_brute_force(spark, folder, monkeypatch, rows_a_bucket):
    monkeypatch.setattr(fingerprints, "ROWS_A_BUCKET", rows_a_bucket)
    rows = [r for r in documents() if r[0] != 113]
    got = {r.doc_id: r for r in QUERIES["op12_document_fingerprints"](spark, folder(rows, clashing=True)).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for (i, text, *_), (_, after, *_) in zip(order, [*order[1:], order[0]]):
        text, after, r = text or "", after or "", got[i]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        bins = [brute_bins(x) for x in (text, edited, after)]
        assert [r.fingerprint, r.edited_fingerprint] == ["".join(f"{x:x}" for x in b or []) for b in bins[:2]]
        assert r.near_edited == pytest.approx(brute_likeness(bins[0], bins[1]), abs=1e-12)
        assert r.near_next == pytest.approx(brute_likeness(bins[0], bins[2]), abs=1e-12)


def test_likeness_estimates_the_similarity_of_shingles(spark):
    base = prose("en", 600, 5)
    rows = [(k, base if k == 0 else changed(base, k), None, None, 0) for k in (0, 12, 25, 50, 100, 300)]
    sets = {i: {tuple(SPLIT(t)[n:n + 5]) for n in range(596)} for i, t, *_ in rows}
    found = fingerprints.fingerprints(frame(spark, rows)).select("doc_id", "fingerprint")
    both = found.join(found.where("doc_id = 0").select(F.col("fingerprint").alias("base")), how="cross")
    for r in both.select("doc_id", fingerprints.likeness(F.col("fingerprint"), F.col("base")).alias("x")).collect():
        assert abs(r.x - len(sets[0] & sets[r.doc_id]) / len(sets[0] | sets[r.doc_id])) < 0.09


def test_fingerprints_build_no_array_anew_per_bin(spark):
    """The filled bins are listed once per text, not once per empty bin whose first places are all empty."""
    found = fingerprints.fingerprints(frame(spark, [(1, "a few words of one short text", None, None, 0)]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    borrowed = plan[plan.index("coalesce(lambda"):]
    depth = list(itertools.accumulate((c == "(") - (c == ")") for c in borrowed))
    borrowed = borrowed[:depth.index(0, len("coalesce("))]
    assert "array_min" in borrowed and "filter(" not in borrowed


@pytest.mark.parametrize("ids", [[None] * 30, [7] * 30, [None] * 9 + [3] * 9 + list(range(9)), [5]])
def test_next_document_where_ids_are_shared_or_null(spark, ids):
    rows = [(i, f"text {k % 12}", None, None, 0) for k, i in enumerate(ids)]
    docs = frame(spark, rows).select("doc_id", "text")
    got = fingerprints.with_next(docs, ["doc_id", "text"], rows_a_bucket=2).collect()
    key = lambda i, t: (i is not None, i or 0, (lambda h: h - 2**64 if h >= 2**63 else h)(xxhash.xxh64_intdigest(t.encode(), 42)))
    order = sorted(((i, t) for i, t, *_ in rows), key=lambda r: key(*r))
    want = collections.Counter((*a, *b) for a, b in zip(order, [*order[1:], order[0]]))
    assert collections.Counter((r.doc_id, r.text, r.next_doc_id, r.next_text) for r in got) == want


# Filter audit


def brute_shapley(n, value):
    """Sum over all orders of what each player adds."""
    total = [0] * n
    for order in itertools.permutations(range(n)):
        done = 0
        for k in order:
            total[k] += value[done | 1 << k] - value[done]
            done |= 1 << k
    return total


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_least_squares_gives_shapley_values(n):
    rng = np.random.default_rng(n)
    weights = filter_audit.shapley_weights(n)
    for _ in range(20):
        value = [int(x) for x in rng.integers(-50, 1000, 1 << n)]
        assert [sum(w * v for w, v in zip(row, value)) for row in weights] == brute_shapley(n, value)


def test_audit_steps_against_runs_of_the_filters(spark, folder):
    rows = [*odd_rows(), (950, prose("en", 250, 3), None, "src0", 1), (951, prose("en", 250, 3), None, "src1", 1), (952, "A B C " * 90 + "#", None, "", 1), (953, "A B C " * 90 + "#", None, None, 1)]
    got = {(r.part, r.filter_order, r.step): r for r in QUERIES["op13_filter_audit"](spark, folder(rows)).collect()}
    labels = collections.defaultdict(lambda: [0, 0])
    for i in {r[0] for r in rows if r[0] is not None and r[0] % 5}:
        labels[i] = [i % 2, i % 3 // 2]
    labels[3][1] = 1
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)

    def fails(i, text):
        text = text or ""
        words = SPLIT(text)
        return {f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            any(c in "#$%&*|" for c in text), i is not None and i > first[text])) if bad}

    marked = [(r[3] or "", fails(r[0], r[1]), labels[r[0]] if r[0] is not None else [0, 0]) for r in rows]
    for part in {m[0] for m in marked}:
        shapley = collections.Counter()
        for order in ("".join(p) for p in itertools.permutations("ABCDE")):
            left = [m for m in marked if m[0] == part]
            everyone = left
            for step, f in enumerate(order, 1):
                gone, left = [m for m in left if f in m[1]], [m for m in left if f not in m[1]]
                r = got[(part, order, step)]
                failing = [m for m in everyone if f in m[1]]
                assert (r.kept, r.removed, r.redundant) == (len(left), len(gone), len(failing) - len(gone))
                assert (r.unique_fails, r.good_lost, r.toxic_lost) == (sum(m[1] == {f} for m in failing), sum(m[2][0] for m in gone), sum(m[2][1] for m in gone))
                shapley[f] += len(gone)
        assert all(r.shapley == shapley[o[s - 1]] for (p, o, s), r in got.items() if p == part)
