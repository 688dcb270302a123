"""The command line runs the three jobs on files."""

from __future__ import annotations

import os

from tessera.__main__ import main
from tests.test_sources import POSTING_LINES, record


def test_terms_and_survey(spark, tmp_dir, capsys):
    p = os.path.join(tmp_dir, "w.dat")
    with open(p, "w") as f:
        f.write("\n".join([record("1", "figs went early"), record("2", "plums and figs")]) + "\n")
    main(["terms", p, "--terms", "figs", "plums", "okra"])
    out = capsys.readouterr().out
    assert "ranking by scan: figs=2, plums=1, okra=0" in out
    assert "ranking by count: figs=2, plums=1" in out
    s = os.path.join(tmp_dir, "s.csv")
    with open(s, "w") as f:
        f.write("tucaseid,telfs,tesex,teage,t010101,t050101,t020101\nA,1,1,15,60,120,30\n")
    main(["survey", s])
    assert "working" in capsys.readouterr().out


def test_clusters(spark, tmp_dir, capsys):
    from tessera.sources.tables import LANGUAGES

    # every language needs kernels / languages vectors: one kernel per language
    lines = list(POSTING_LINES)
    p = os.path.join(tmp_dir, "so.csv")
    for i, lang in enumerate(LANGUAGES):
        lines += [f"1,{1000 + i},,,0,{lang}", f"2,{2000 + i},,{1000 + i},{i}"]
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    main(["clusters", p, "--kernels", "15"])
    out = capsys.readouterr().out
    assert "Iteration: 1" in out and "Resulting clusters:" in out
    assert "  Score  Dominant language (%percent)  Questions" in out


def test_parquet_inputs(spark, tmp_dir, capsys):
    from tests.conftest import SF_SMALL
    from tessera.sources import tables as S

    a = os.path.join(tmp_dir, "articles.parquet")
    S.articles(spark, SF_SMALL).write.parquet(a)
    main(["terms", a, "--parquet", "--terms", "the", "zzz"])
    assert "ranking by scan: the=" in capsys.readouterr().out
    s = os.path.join(tmp_dir, "survey.parquet")
    S.survey_table(spark, SF_SMALL).write.parquet(s)
    main(["survey", s, "--parquet"])
    assert "not working" in capsys.readouterr().out


def test_list_and_query(spark, capsys):
    from tests.conftest import SF_SMALL

    main(["list"])
    names = capsys.readouterr().out.split()
    assert "rank_terms_count" in names and "kmeans" in names
    main(["query", "time_usage_grouped", SF_SMALL, "--rows", "3"])
    out = capsys.readouterr().out
    assert "primaryNeeds" in out and "only showing top 3 rows" in out
