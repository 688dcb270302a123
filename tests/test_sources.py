"""Line reader, article and posting parsers, survey reader."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import Row
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tessera.sources.articles import parse_articles, read_articles
from tessera.sources.lines import read_lines
from tessera.sources.postings import parse_postings, read_postings
from tessera.sources.survey import read_survey, read_survey_arrays, survey_arrays, survey_row, survey_schema
from tessera.sources.tables import ARTICLE_LEAD, ARTICLE_TRAIL


def write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def record(title, text):
    return f"{ARTICLE_LEAD}{title}</title><text>{text}{ARTICLE_TRAIL}"


def test_read_lines(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "a.txt"), ["one", "two", "three"])
    assert [r.value for r in read_lines(spark, p).collect()] == ["one", "two", "three"]


def test_parse_article_line(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "w.dat"), [record("Kiwi", "Kiwis do not fly"), record("B", "")])
    rows = read_articles(spark, p).collect()
    assert rows == [Row(title="Kiwi", text="Kiwis do not fly"), Row(title="B", text="")]


def test_first_delimiter_wins(spark):
    line = record("T", "a </title><text> b")
    df = spark.createDataFrame([(line,)], "value string")
    assert parse_articles(df).first() == Row(title="T", text="a </title><text> b")


def test_malformed_article_fails_or_is_flagged(spark):
    df = spark.createDataFrame([(record("ok", "fine"),), ("no delimiter here at all, long enough",)], "value string")
    with pytest.raises(Exception, match="malformed article line"):
        parse_articles(df).collect()
    for column in ("title", "text"):  # each column alone, and none
        with pytest.raises(Exception, match="malformed article line"):
            parse_articles(df).select(column).collect()
    with pytest.raises(Exception, match="malformed article line"):
        parse_articles(df).count()
    rows = parse_articles(df, strict=False).collect()
    assert rows[0] == Row(title="ok", text="fine", malformed=False)
    assert rows[1] == Row(title=None, text=None, malformed=True)


POSTING_LINES = [
    "1,100,,,5,Java",
    "2,101,,100,3",
    "2,102,,100,7",
    "1,200,,,0,Scala",
    "2,201,,200,-4",
    "1,300,,,1,Fortran",
    "2,301,,300,2",
    "1,400,,,9,PHP",
    "2,501,,999,8",
    "2,502,,,8",
    "1,600,,,3,",
]


def test_parse_postings_fields(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "so.csv"), POSTING_LINES)
    rows = {r.id: r for r in read_postings(spark, p).collect()}
    assert rows[100] == Row(posting_type=1, id=100, accepted_answer=None, parent_id=None, score=5, tag="Java")
    assert rows[101] == Row(posting_type=2, id=101, accepted_answer=None, parent_id=100, score=3, tag=None)
    assert rows[201].score == -4
    assert rows[502].parent_id is None
    assert rows[600].tag is None  # trailing empty tag
    assert len(rows) == len(POSTING_LINES)


def test_posting_extra_fields_ignored(spark):
    df = spark.createDataFrame([("1,7,3,,2,Java,extra,more",)], "value string")
    assert parse_postings(df).first() == Row(
        posting_type=1, id=7, accepted_answer=3, parent_id=None, score=2, tag="Java"
    )


@pytest.mark.parametrize(
    "line", ["1,x,,,3,PHP", "1,5,,,", "1,5", " 1,5,,,3", "1,5,,,3.5", "1,99999999999999999999,,,3", "1,5,,,9999999999"]
)
def test_bad_posting_fails_the_job(spark, tmp_dir, line):
    p = write(os.path.join(tmp_dir, "bad.csv"), ["1,100,,,5,Java", line])
    df = read_postings(spark, p)
    for use in (df, *(df.select(c) for c in df.columns)):  # whichever columns are read
        with pytest.raises(Exception, match="malformed posting line"):
            use.collect()
    with pytest.raises(Exception, match="malformed posting line"):
        df.count()


def test_malformed_line_fails_every_ranking(spark, tmp_dir):
    from tessera.operators import terms as T
    from tessera.plans import pipelines as PL

    p = write(os.path.join(tmp_dir, "w.dat"), [record("ok", "kiwi"), "kiwi kiwi but no delimiter in this line"])
    articles = read_articles(spark, p)
    for df in (
        T.rank_terms_scan(articles, ["kiwi"]),
        T.rank_terms_count(articles, ["kiwi"]),
        T.rank_terms_index(T.inverted_index(articles, ["kiwi"])),
        PL.pipeline_terms(articles, ["kiwi"]),
    ):
        with pytest.raises(Exception, match="malformed article line"):
            df.collect()


def test_bad_posting_lenient(spark):
    df = spark.createDataFrame([("1,x,,,3,PHP",), ("2,5,,4,1",)], "value string")
    rows = parse_postings(df, strict=False).collect()
    assert rows[0].id is None and rows[0].malformed
    assert rows[1].parent_id == 4 and not rows[1].malformed


def test_survey_schema():
    assert survey_schema(["person", "north", "south"]) == StructType(
        [
            StructField("person", StringType(), False),
            StructField("north", DoubleType(), False),
            StructField("south", DoubleType(), False),
        ]
    )


def test_survey_row():
    assert survey_row("p7,2.5,-1,40".split(",")) == Row("p7", 2.5, -1.0, 40.0)
    with pytest.raises(ValueError):
        survey_row(["A", "x"])


def test_read_survey_many_files(spark, tmp_dir):
    d = os.path.join(tmp_dir, "survey")
    os.makedirs(d)
    header = "tucaseid,telfs,t010101"
    write(os.path.join(d, "part1.csv"), [header, "a,1,60", "b,2,30"])
    write(os.path.join(d, "part2.csv"), [header, "c,5,90"])
    names, df = read_survey(spark, d)
    assert names == ["tucaseid", "telfs", "t010101"]
    assert sorted(tuple(r) for r in df.collect()) == [("a", 1.0, 60.0), ("b", 2.0, 30.0), ("c", 5.0, 90.0)]


def test_read_survey_bad_number_and_empty_field(spark, tmp_dir):
    for i, line in enumerate(["a,x,1", "a,,1", "a,1", "a,1,2,3", ",1,2", "a,1,y"]):
        p = write(os.path.join(tmp_dir, f"bad{i}.csv"), ["tucaseid,telfs,t500101", line])
        _, df = read_survey(spark, p)
        for use in (df, df.select("telfs")):  # every field is checked, whichever are read
            with pytest.raises(Exception, match="malformed survey line"):
                use.collect()
    p = write(os.path.join(tmp_dir, "empty.csv"), ["tucaseid,telfs", "a,"])
    assert read_survey(spark, p, strict=False)[1].first()["telfs"] is None


def test_survey_quotes_are_characters(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "quotes.csv"), ["tucaseid,telfs", '"a,1', 'b"b,2'])
    for strict in (True, False):
        assert [tuple(r) for r in read_survey(spark, p, strict)[1].collect()] == [('"a', 1.0), ('b"b', 2.0)]


def test_survey_headers_that_differ_are_refused(spark, tmp_dir):
    d = os.path.join(tmp_dir, "orders")
    os.makedirs(d)
    write(os.path.join(d, "a.csv"), ["tucaseid,telfs,tesex", "a,1,2"])
    write(os.path.join(d, "b.csv"), ["tucaseid,tesex,telfs", "b,1,2"])
    for strict in (True, False):
        with pytest.raises(Exception):
            read_survey(spark, d, strict)[1].select("telfs", "tesex").collect()


def test_column_pruning_reaches_the_reader(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "wide.csv"), ["id,a,b,c", "x,1,2,3"])
    _, df = read_survey(spark, p, strict=False)
    from tests.conftest import plan_text

    assert "ReadSchema: struct<a:double>" in plan_text(df.select("a"))


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("strict", [True, False])
def test_a_line_is_split_once(spark, tmp_dir, strict):
    postings = read_postings(spark, write(os.path.join(tmp_dir, "p.csv"), POSTING_LINES), strict)
    for use in (postings, postings.where("score > 3 and id > 5"), postings.select("id", "score", "parent_id")):
        assert optimized(use).count("split(") == 1
    articles = read_articles(spark, write(os.path.join(tmp_dir, "w.dat"), [record("a", "b")]), strict)
    assert optimized(articles).count("instr(") == 1


def test_a_survey_line_is_split_once(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "s.csv"), ["tucaseid,telfs,tesex,teage,t010101", "a,1,2,3,4"])
    for df in (read_survey(spark, p)[1], read_survey_arrays(spark, p)[1]):
        assert optimized(df).count("split(") == 1 and optimized(df).count("transform(slice(") == 1


def test_a_computed_line_is_computed_once(spark):
    df = spark.range(5).selectExpr("concat_ws(',', '1', id, '', '', '3') AS value")
    assert optimized(parse_postings(df)).count("concat_ws(") <= 2  # twice where the plan shows it twice
    assert sorted(r.id for r in parse_postings(df).collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("strict", [True, False])
def test_only_the_first_line_of_a_file_is_its_header(spark, tmp_dir, strict):
    """Names that are numbers: a data line may then equal the header."""
    d = os.path.join(tmp_dir, "files")
    os.makedirs(d)
    write(os.path.join(d, "a.csv"), ["p,1,2", "p,1,2", "q,3,4"])
    write(os.path.join(d, "b.csv"), ["p,1,2", "r,5,6", "p,1,2", "p,1,2"])
    _, df = read_survey(spark, d, strict)
    assert sorted(tuple(r) for r in df.collect()) == sorted([("p", 1.0, 2.0)] * 3 + [("q", 3.0, 4.0), ("r", 5.0, 6.0)])


def test_a_header_of_numbers_that_differs_is_refused(spark, tmp_dir):
    d = os.path.join(tmp_dir, "files")
    os.makedirs(d)
    write(os.path.join(d, "a.csv"), ["p,1,2", "q,3,4"])
    write(os.path.join(d, "b.csv"), ["p,1,3", "r,5,6"])
    for read in (read_survey, lambda s, p: read_survey_arrays(s, p, keys=("1",) if _has_header(s, p, "p,1,2") else ("3",))):
        with pytest.raises(Exception, match="(?i)header"):
            read(spark, d)[1].collect()


def _has_header(spark, path, header):
    return spark.read.text(path).first()[0] == header


def test_a_split_file_has_one_header(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "long.csv"), ["p,1,2"] + ["p,1,2", "q,3,4"] * 3000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_survey(spark, p)[1]
        assert df.rdd.getNumPartitions() > 4 and df.count() == 6000
        assert df.where("`1` = 1").count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_array_table(spark, tmp_dir):
    header = ["tucaseid", "t010101", "telfs", "t050101", "tesex", "teage", "t170101"]
    lines = ["a,10,1,20,1,30,5", "b,1.5,5,2.5,2,20,6", "c,-1,2,0,2,60,1e2"]
    p = write(os.path.join(tmp_dir, "s.csv"), [",".join(header), *lines])
    names, df = read_survey_arrays(spark, p)
    assert names == ["t010101", "t050101", "t170101"]
    assert df.columns == ["tucaseid", "telfs", "tesex", "teage", "values"]
    assert {r.tucaseid: list(r["values"]) for r in df.collect()} == {"a": [10, 20, 5], "b": [1.5, 2.5, 6], "c": [-1, 0, 100]}
    again = survey_arrays(read_survey(spark, p)[1])
    assert again[0] == names and sorted(map(tuple, again[1].collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError, match="no column"):
        read_survey_arrays(spark, p, keys=("telfs", "nothere"))
    for i, line in enumerate(["a,x,1,1,1,1,1", "a,1,1", ",1,1,1,1,1,1", "a,1,1,1,1,1,"]):
        bad = write(os.path.join(tmp_dir, f"bad{i}.csv"), [",".join(header), line])
        for use in (read_survey_arrays(spark, bad)[1], read_survey_arrays(spark, bad)[1].select("tesex")):
            with pytest.raises(Exception, match="malformed survey line"):
                use.collect()
