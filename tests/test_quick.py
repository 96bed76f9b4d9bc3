"""Quick verification: which lines are read for a question."""

from quarrylight.operators import quick


def test_first_reads(spark):
    long = "\n".join(f"line {k}" for k in range(1, 151))
    docs = spark.createDataFrame([("a", long), ("b", "one\ntwo\nthree")], "doc_id string, text string")
    questions = spark.createDataFrame([(1, "What is this?"), (2, "when?"), (3, "overview"), (4, "same"), (5, "none"), (6, "是什么"), (7, None)], "question_id int, question string")
    hits = [(1, 1, "a", 40), (1, 2, "a", 90), (2, 1, "a", 40), (2, 2, "b", 2), (2, 3, "b", 1), (3, 1, "a", 5), (3, 2, "b", 3), (4, 1, "b", 2), (4, 2, "b", 2), (5, 1, "b", 9), (5, 2, "b", 1), (6, 1, "b", 3), (6, 2, "b", 1), (7, 1, "gone", 1), (7, 2, "a", 150)]
    got = quick.first_reads(questions, spark.createDataFrame(hits, "question_id int, rank int, doc_id string, start_line long"), docs)
    assert sorted((r.question_id, r.nth, r.doc_id, r.start_line, r.lines_read, r.next_start_line) for r in got.collect()) == [
        (1, 1, "a", 1, 100, 101),
        (1, 2, "a", 101, 50, None),
        (2, 1, "a", 40, 100, 140),
        (2, 2, "b", 2, 2, None),
        (3, 1, "a", 5, 100, 105),
        (3, 2, "b", 3, 1, None),
        (4, 1, "b", 2, 2, None),
        (5, 2, "b", 1, 3, None),
        (6, 1, "b", 1, 3, None),
        (7, 2, "a", 150, 1, None),
    ]
    assert got.where("question_id = 1 and nth = 2").first().text.startswith("line 101\nline 102")
