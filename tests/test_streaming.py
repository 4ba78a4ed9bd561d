from test_clean import HEADER, _line

from orderlens.streaming import refresh


def test_refresh_runs_only_on_new_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("\n".join([HEADER, _line("O1"), _line("O2", date="2025-03-10")]) + "\n")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    assert refresh(spark, str(landing), out, ckpt) == 1
    wk = spark.read.parquet(out + "/weekly_kpis")
    assert wk.count() == 2
    assert refresh(spark, str(landing), out, ckpt) == 0
    (landing / "b.csv").write_text("\n".join([HEADER, _line("O3", date="2025-03-17")]) + "\n")
    assert refresh(spark, str(landing), out, ckpt) == 1
    assert spark.read.parquet(out + "/weekly_kpis").count() == 3
