from farelens.llm import exact_dedup

from .helpers import as_dicts, documents, sha

ROWS = [(1, "a b"), (5, "a b"), (3, "a b "), (4, None), (7, ""), (8, "x" * 200_000), (9, "x" * 200_000), (2, "é")]


def test_groups_by_whole_content(spark):
    got = as_dicts(exact_dedup.mark_copies(documents(spark, ROWS, clash=True)))
    keep = {1: 5, 5: 5, 3: 3, 4: 7, 7: 7, 8: 9, 9: 9, 2: 2}
    assert {i: r["keep_id"] for i, r in got.items()} == keep
    assert {i: r["kept"] for i, r in got.items()} == {i: i == k for i, k in keep.items()}
    assert {i: r["group_size"] for i, r in got.items()} == {i: 2 if [*keep.values()].count(k) == 2 else 1 for i, k in keep.items()}
    assert all(got[i]["text_sha256"] == sha(t or "") for i, t in ROWS)


def test_null_ids_and_repeated_rows(spark):
    docs = documents(spark, [(None, "p"), (None, "q"), (1, "q"), (2, "r"), (2, "r")])
    got = sorted(map(tuple, exact_dedup.mark_copies(docs).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert got == [(1, 1, 2, True), (2, 2, 2, True), (2, 2, 2, True), (None, 1, 2, False), (None, None, 1, True)]
    kept = exact_dedup.drop_copies(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("1", "q"), ("2", "r"), ("None", "p")]


def test_whole_rows_of_the_winners(spark):
    docs = documents(spark, ROWS, clash=True)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {5: "a b", 3: "a b ", 7: "", 9: "x" * 200_000, 2: "é"}


def test_hot_text_over_many_tasks(spark):
    docs = documents(spark, [(i, "hot" if i % 3 else f"t{i}") for i in range(600)], partitions=20)
    got = as_dicts(exact_dedup.mark_copies(docs, salts=4))
    assert sum(r["kept"] for r in got.values()) == 201 and got[1]["group_size"] == 400 and got[1]["keep_id"] == 599


def test_empty_table(spark):
    docs = documents(spark, [])
    assert exact_dedup.mark_copies(docs).count() == 0 and exact_dedup.drop_copies(docs).count() == 0
