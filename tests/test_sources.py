import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.sources import bindings as B
from quarry.sources.articles import MARKER, parse_articles
from quarry.sources.postings import parse_postings
from quarry.sources.text import read_lines
from quarry.sources.wide import parse_wide_lines, read_wide_csv, wide_schema


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def write_lines(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


# -- article lines --------------------------------------------------------------

def test_article_lines_from_a_file(spark, scratch):
    lines = ["<page> <title>Scala" + MARKER + "Scala is great</text> </page> ",
             "<page> <title>" + MARKER + "no title here.</text> </page> "]
    path = write_lines(scratch, "articles.txt", lines)
    got = parse_articles(read_lines(spark, path)).collect()
    assert [(r["title"], r["text"]) for r in got] == [("Scala", "Scala is great"), ("", "no title here.")]


def test_article_wrappers_are_counted_not_checked(spark):
    line = "x" * 14 + "T" + MARKER + "body" + "y" * 16
    r = parse_articles(lines_df(spark, [line])).collect()[0]
    assert (r["title"], r["text"]) == ("T", "body")


def test_article_without_marker_fails_strict(spark):
    with pytest.raises(Exception, match="malformed article line"):
        parse_articles(lines_df(spark, ["<page> <title>no marker at all</text> </page> "])).collect()


def test_article_lenient_splits_rejects(spark):
    good_line = "<page> <title>A" + MARKER + "ok</text> </page> "
    df = lines_df(spark, [good_line, "short", "<page> <title>B" + MARKER + "x"])
    good, bad = parse_articles(df, mode="lenient")
    assert [(r["title"], r["text"]) for r in good.collect()] == [("A", "ok")]
    assert bad.count() == 2


def test_article_binding_round_trip(spark):
    parsed = parse_articles(B.article_lines(spark, SF_SMALL)).select("doc_id", "title", "text")
    orig = B.articles(spark, SF_SMALL)
    assert parsed.exceptAll(orig).count() == 0 and orig.exceptAll(parsed).count() == 0


# -- posting lines --------------------------------------------------------------

def test_posting_fields(spark):
    df = lines_df(spark, ["1,27233496,,,0,C#", "2,23698767,,9002525,2", "1,5,7,,3,", "2,9,,4,-2,Java,extra",
                          "1,6,,,1,\"Java\""])
    rows = [tuple(r) for r in parse_postings(df).collect()]
    assert rows == [(1, 27233496, None, None, 0, "C#"),
                    (2, 23698767, None, 9002525, 2, None),
                    (1, 5, 7, None, 3, None),          # empty trailing field: no tag
                    (2, 9, None, 4, -2, "Java"),       # fields past the sixth ignored
                    (1, 6, None, None, 1, '"Java"')]   # quotes are plain characters


def test_posting_bad_number_fails_strict(spark):
    with pytest.raises(Exception, match="malformed posting line"):
        parse_postings(lines_df(spark, ["1,abc,,,0,C#"])).collect()
    with pytest.raises(Exception, match="malformed posting line"):
        parse_postings(lines_df(spark, ["1,2,,"])).collect()


def test_posting_lenient(spark):
    good, bad = parse_postings(lines_df(spark, ["1,1,,,0,C#", "x,1,,,0", "1,2,z,,0"]), mode="lenient")
    assert good.count() == 1 and bad.count() == 2


def test_posting_lines_from_a_file(spark, scratch):
    path = write_lines(scratch, "postings.csv", ["1,10,,,5,Scala", "2,11,,10,3"])
    rows = [tuple(r) for r in parse_postings(read_lines(spark, path)).collect()]
    assert rows == [(1, 10, None, None, 5, "Scala"), (2, 11, None, 10, 3, None)]


def test_posting_binding_round_trip(spark):
    parsed = parse_postings(B.posting_lines(spark, SF_SMALL))
    orig = B.postings(spark, SF_SMALL)
    assert parsed.schema.simpleString() == orig.schema.simpleString()
    assert parsed.exceptAll(orig).count() == 0 and orig.exceptAll(parsed).count() == 0


# -- wide CSV ---------------------------------------------------------------------

def test_wide_schema():
    s = wide_schema(["id", "a", "b"])
    assert [f.dataType.simpleString() for f in s.fields] == ["string", "double", "double"]
    assert not any(f.nullable for f in s.fields)
    assert wide_schema(["only"]).fields[0].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        wide_schema([])


def test_wide_csv_folder_each_file_with_header(spark, scratch):
    folder = os.path.join(scratch, "wide")
    os.makedirs(folder)
    write_lines(folder, "part1.csv", ["tucaseid,telfs,t010101", "a,1,30", "b,5,60"])
    write_lines(folder, "part2.csv", ["tucaseid,telfs,t010101", "c,2,\"90\"".replace('"', "")])
    names, df = read_wide_csv(spark, folder)
    assert names == ["tucaseid", "telfs", "t010101"]
    assert sorted(tuple(r) for r in df.collect()) == [("a", 1.0, 30.0), ("b", 5.0, 60.0), ("c", 2.0, 90.0)]


def test_wide_csv_bad_number_fails(spark, scratch):
    path = write_lines(scratch, "bad.csv", ["id,x", "a,notanumber"])
    _, df = read_wide_csv(spark, path)
    with pytest.raises(Exception):
        df.collect()


def test_wide_lines_match_binding(spark):
    names, df = parse_wide_lines(B.respondent_lines(spark, SF_SMALL))
    assert names == list(B.RESPONDENT_COLUMNS)
    orig = B.respondents(spark, SF_SMALL)
    assert df.exceptAll(orig).count() == 0 and orig.exceptAll(df).count() == 0


def test_wide_projection_prunes_the_scan(spark):
    r = B.respondents(spark, SF_SMALL).where(F.col("telfs") <= 4).select("t010101")
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_linenumber), LessThanOrEqual(l_linenumber,4)]" in plan
    assert "l_returnflag" not in plan and "l_shipdate" not in plan


def test_strict_checks_survive_column_pruning(spark):
    with pytest.raises(Exception, match="malformed posting line"):
        parse_postings(lines_df(spark, ["1,2,,,0,C#", "1,x,,,0"])).select("tags").collect()
    with pytest.raises(Exception, match="malformed article line"):
        parse_articles(lines_df(spark, ["no marker"])).select().count()


def test_local_table_values_and_no_job(spark):
    from quarry.session import local_table
    st = spark.sparkContext.statusTracker()
    tricky = ["it's C#", None, "a\\b", "", "x\ny\t'\"", "ünï€😀", "--;DROP"]
    df = local_table(spark, {"k": "int", "cx": "bigint", "t": "string"},
                     [(i, (-3) ** i * 2 ** 40, t) for i, t in enumerate(tricky)])
    before = len(st.getJobIdsForGroup(None))
    rows = [tuple(r) for r in df.collect()]
    assert rows == [(i, (-3) ** i * 2 ** 40, t) for i, t in enumerate(tricky)]
    assert len(st.getJobIdsForGroup(None)) == before
    assert df.schema.simpleString() == "struct<k:int,cx:bigint,t:string>"
    assert local_table(spark, {"a": "int"}, []).count() == 0


def test_reread_reads_the_checkpoint_not_the_tables(spark):
    from quarry.session import reread
    orders = B.table(spark, SF_SMALL, "orders").select("o_orderkey", "o_orderpriority")
    again = reread(orders.where(F.col("o_orderpriority") == "1-URGENT"))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "ExistingRDD" in plan
    assert sorted(again.collect()) == sorted(orders.where(F.col("o_orderpriority") == "1-URGENT").collect())


def test_wide_files_with_other_headers_fail(spark, scratch):
    from quarry.sources.wide import read_wide_csv
    for name, text in (("a.csv", "id,telfs,t010101\nx,1,2\n"), ("b.csv", "id,t010101,telfs\ny,500,2\n")):
        with open(f"{scratch}/{name}", "w") as f:
            f.write(text)
    with pytest.raises(Exception):
        read_wide_csv(spark, scratch)[1].collect()


@pytest.mark.parametrize("row", ["x,1,", "x,1", "x,1,bad"])
def test_wide_missing_or_bad_number_fails_in_an_unread_column(spark, scratch, row):
    from quarry.sources.wide import parse_wide_lines, read_wide_csv
    with open(f"{scratch}/a.csv", "w") as f:
        f.write(f"id,telfs,t010101\nw,1,2\n{row}\n")
    with pytest.raises(Exception):
        read_wide_csv(spark, f"{scratch}/a.csv")[1].select("telfs").collect()
    lines = spark.createDataFrame([("id,telfs,t010101",), ("w,1,2",), (row,)], "value string").coalesce(1)
    with pytest.raises(Exception):
        parse_wide_lines(lines)[1].select("telfs").collect()


def test_posting_lines_of_any_width(spark):
    from quarry.sources.postings import parse_postings
    lines = ["1000000000,5,,,0,a", "1,5,,,0,a b", "1,5,,,0,,x", "1,5,,,0,", "1,5,,,0,,", "0000000000001,5,,,0"]
    rows = parse_postings(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r["posting_type"] for r in rows] == [1000000000, 1, 1, 1, 1, 1]
    assert [r["tags"] for r in rows] == ["a", "a b", "", None, None, None]
    bad = spark.createDataFrame([("99999999999,5,,,0",), ("1,5,,,0",)], "value string")
    good, rejects = parse_postings(bad, mode="lenient")
    assert good.count() == 1 and rejects.count() == 1


WIDE_LINES = ["id,a,b", "x,1,2", "y,1", "z,1,2,3", "u,,2", "v,1,q", "w, 1 ,-2e3", "", ",1,2", "k,1, ", "n,NaN,1"]
WIDE_ROWS = [("", 1.0, 2.0), ("w", 1.0, -2000.0), ("x", 1.0, 2.0)]
WIDE_REJECTS = [("k,1, ", "missing number", "b"), ("u,,2", "missing number", "a"), ("v,1,q", "malformed number", "b"),
                ("y,1", "too few fields", None), ("z,1,2,3", "too many fields", None)]


def _wide_frames(spark, scratch, mode):
    from quarry.sources.wide import parse_wide_lines, read_wide_csv
    write_lines(scratch, "a.csv", WIDE_LINES[:5])
    write_lines(scratch, "b.csv", WIDE_LINES[:1] + WIDE_LINES[5:])
    lines = spark.createDataFrame([(x,) for x in WIDE_LINES] + [(None,)], "value string").coalesce(1)
    return read_wide_csv(spark, scratch, mode=mode)[1:], parse_wide_lines(lines, mode=mode)[1:]


def test_wide_lenient_rows_and_rejects(spark, scratch):
    for rows, rejects in _wide_frames(spark, scratch, "lenient"):
        assert [f.dataType.simpleString() for f in rows.schema.fields] == ["string", "double", "double"]
        assert rejects.dtypes == [("line", "string"), ("reason", "string"), ("column", "string")]
        assert sorted(tuple(r) for r in rows.where("id <> 'n'").collect()) == WIDE_ROWS
        assert rows.where("id = 'n' AND isnan(a)").count() == 1
        assert sorted(tuple(r) for r in rejects.collect()) == WIDE_REJECTS


def test_wide_permissive_keeps_bad_lines(spark, scratch):
    for (df,) in _wide_frames(spark, scratch, "permissive"):
        got = {r["id"]: (r["a"], r["b"], r["_corrupt_record"]) for r in df.where("id <> 'n'").collect()}
        assert got == {"x": (1.0, 2.0, None), "y": (1.0, None, "y,1"), "z": (1.0, 2.0, "z,1,2,3"), "u": (None, 2.0, "u,,2"),
                       "v": (1.0, None, "v,1,q"), "w": (1.0, -2000.0, None), "": (1.0, 2.0, None), "k": (1.0, None, "k,1, ")}


def test_wide_other_header_fails_in_every_mode(spark, scratch):
    from quarry.sources.wide import read_wide_csv
    write_lines(scratch, "a.csv", ["id,a,b", "x,1,2"])
    write_lines(scratch, "b.csv", ["id,b,a", "y,1,2"])
    for mode in ("strict", "lenient", "permissive"):
        with pytest.raises(Exception):
            for df in read_wide_csv(spark, scratch, mode=mode)[1:]:
                df.count()
    with pytest.raises(ValueError):
        read_wide_csv(spark, scratch, mode="loose")


def test_written_files_hold_a_header_each(spark):
    import glob
    path = B.damaged_respondent_files(spark, SF_SMALL)
    files = glob.glob(f"{path.removeprefix('file:')}/*.csv")
    assert len(files) >= B.FILES
    assert all(open(f).readline().rstrip("\n") == ",".join(B.RESPONDENT_COLUMNS) for f in files)


def test_scratch_folders_can_be_cleared(spark):
    import glob
    from quarry.session import clear_scratch
    path = B.posting_files(spark, SF_SMALL).removeprefix("file:")
    assert glob.glob(f"{path}/*.txt")
    assert clear_scratch(spark) and not glob.glob(f"{path}/*") and not clear_scratch(spark)


def test_lines_are_parsed_once(spark):
    """One split and one cast of a line, however many columns and checks use them."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    wide = plan(parse_wide_lines(B.respondent_lines(spark, SF_SMALL))[1])
    assert wide.count("split(") == 1 and wide.count("array<double>") == 1 and wide.count("from_csv") == 0
    assert wide.count("concat_ws(") == 1
    posting = plan(parse_postings(lines_df(spark, ["1,2,,,0"])))
    assert posting.count("split(") == 1 and posting.count("as bigint)") == 4 and posting.count("as int)") == 1
