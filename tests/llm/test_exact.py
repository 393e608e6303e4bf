import hashlib

import pytest

from touchledger.llm.exact import DigestIndex


def sha(text):
    return hashlib.sha256((text or "").encode()).digest()


def result(frame):
    return sorted(((r["doc_id"], bytes(r["digest"]), r["keep_id"], r["group_size"], r["kept"]) for r in frame.collect()), key=str)


def test_largest_id_stays_nulls_repeats_and_clashing_columns(llm, documents, workspace, tmp_path):
    rows = [(1, "a", "x", 1), (5, "a", "x", 2), (3, "a", None, 3), (2, None, "x", 4), (4, "", "x", 5), (6, "A", "x", 6),
            (None, "a", "x", 7), (None, "lone", "x", 8), (6, "A", "x", 6)]
    frame = documents(*rows, schema="doc_id bigint, text string, digest string, row int")
    got = result(DigestIndex(llm, str(tmp_path / "index"), 4).add(frame, workspace))
    assert sum(g[4] for g in got) == 4
    assert [g for g in got if g[1] == sha("a")] == sorted(
        [(1, sha("a"), 5, 4, False), (5, sha("a"), 5, 4, True), (3, sha("a"), 5, 4, False), (None, sha("a"), 5, 4, False)], key=str)
    assert [g for g in got if g[1] == sha("")] == [(2, sha(""), 4, 2, False), (4, sha(""), 4, 2, True)]
    assert [g for g in got if g[1] == sha("lone")] == [(None, sha("lone"), None, 1, True)]
    assert sorted(g[4] for g in got if g[1] == sha("A")) == [False, True]


def test_index_outlives_the_handle(llm, documents, workspace, tmp_path):
    path = str(tmp_path / "index")
    assert DigestIndex(llm, path, 4).add(documents((1, "a"), (2, "b")), workspace).where("kept").count() == 2
    later = DigestIndex(llm, path, 4)
    got = result(later.add(documents((9, "a"), (8, "c"), (7, "c")), workspace))
    assert got == sorted([(9, sha("a"), 1, 1, False), (8, sha("c"), 8, 2, True), (7, sha("c"), 8, 2, False)], key=str)
    assert later.rows().count() == 3
    assert later.add(documents(schema="doc_id bigint, text string"), workspace).count() == 0


def test_another_number_of_buckets(llm, documents, workspace, tmp_path):
    path, rows = str(tmp_path / "index"), [(i, f"text {i}") for i in range(200)]
    assert DigestIndex(llm, path, 8).add(documents(*rows), workspace).where("kept").count() == 200
    before = llm.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("3", "16"):
            llm.conf.set("spark.sql.shuffle.partitions", partitions)
            later = DigestIndex(llm, path)
            got = later.add(documents(*rows, (999, "new " + partitions)), workspace)
            assert later.buckets == 8 and got.count() == 201 and got.where("kept").count() == 1
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", before)
    for buckets in (4, 16):
        with pytest.raises(ValueError, match="has 8 buckets"):
            DigestIndex(llm, path, buckets)
    assert DigestIndex(llm, path, 8).rows().count() == 202


def test_a_batch_entered_again_keeps_what_it_kept(llm, documents, workspace, tmp_path):
    index = DigestIndex(llm, str(tmp_path / "index"), 4)
    index.add(documents((1, "a")), workspace, "first")
    batch = documents((2, "a"), (3, "b"), (4, "b"), (5, None))
    once = result(index.add(batch, workspace, "second"))
    assert result(index.add(batch, workspace, "second")) == once and [g[0] for g in once if g[4]] == [4, 5]
    assert sorted(r["doc_id"] for r in index.keep(batch, workspace, "second").collect()) == [4, 5]
    assert result(index.add(batch, workspace, "third")) and index.rows().count() == 3
    assert not [g for g in result(index.add(batch, workspace, "third")) if g[4]]


def test_kept_documents_have_all_their_columns(llm, documents, workspace, tmp_path):
    rows = [(1, "a", "x"), (2, "a", "y"), (2, "a", "y"), (None, "b", "z"), (4, None, None)]
    frame = documents(*rows, schema="doc_id bigint, text string, lang string")
    kept = DigestIndex(llm, str(tmp_path / "index"), 4).keep(frame, workspace)
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_only_native_operations_and_no_exchange_of_the_index(llm, documents, workspace, tmp_path):
    index = DigestIndex(llm, str(tmp_path / "index"), 4)
    index.add(documents((1, "a")), workspace)
    before = llm.conf.get("spark.sql.adaptive.enabled")
    try:
        llm.conf.set("spark.sql.adaptive.enabled", "false")
        frame = index.rows().hint("merge")
        plan = documents((1, "a")).selectExpr("unhex(sha2(text, 256)) digest").groupBy("digest").count().join(
            frame, "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        llm.conf.set("spark.sql.adaptive.enabled", before)
    scanned = plan[plan.index("SortMergeJoin"):]
    assert "Python" not in plan and scanned.count("Exchange") <= 1
