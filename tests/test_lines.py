from slatemill import line_queries as L


def late_pages(spark, tmp_path):
    """Sections and questions on pages from 21,474 on, whose places pass what an int holds."""
    lines = [("l0", 1, 1, "例题讲解"), ("l1", 21474, 1, "1．甲"), ("l2", 21475, 1, "2．乙"), ("l3", 30000, 1, "例题讲解"), ("l4", 30000, 2, "1．丙"), ("l5", 30001, 1, "末行")]
    spark.createDataFrame([(k, "d", page, pos, text) for k, page, pos, text in lines], "line_id string, doc_id string, page int, pos int, text string").write.parquet(f"{tmp_path}/ocr_lines.parquet")
    return str(tmp_path)


def test_question_ends_beyond_an_int(spark, tmp_path, rows):
    got = rows(L.question_ends(spark, late_pages(spark, tmp_path)), "line_id", "section_id", "end_place")
    assert got == {("l1", "l0", 2147500000), ("l2", "l0", 3000000000), ("l4", "l3", 3000100001)}


def test_section_ranges_beyond_an_int(spark, tmp_path, rows):
    got = rows(L.section_ranges(spark, late_pages(spark, tmp_path)), "line_id", "begin_place", "end_place")
    assert got == {("l0", 100001, 3000000000), ("l3", 3000000001, 3000100001)}
