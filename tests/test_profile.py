"""Mergeable distinct counts."""

from lokum.operators import profile


def rows(spark, lo, hi, portal="olx"):
    return spark.range(lo, hi).selectExpr(f"'{portal}' AS portal", "concat('olx-', id) AS external_id")


def test_runs_merge_without_their_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    profile.append_profile(rows(spark, 0, 30_000), path, "1")
    profile.append_profile(rows(spark, 20_000, 50_000), path, "2")
    profile.append_profile(rows(spark, 20_000, 50_000), path, "2")  # again
    profile.append_profile(rows(spark, 0, 3, "fb"), path, "3")
    got = {r.portal: r for r in profile.merged_profile(spark, path).collect()}
    assert abs(got["olx"].distinct_ids - 50_000) <= 50_000 * profile.ERROR
    assert (got["olx"].n_runs, got["olx"].n_rows) == (2, 60_000)
    assert (got["fb"].distinct_ids, got["fb"].n_runs, got["fb"].n_rows) == (3, 1, 3)


def test_blank_keys_and_empty_runs(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("olx", None), ("olx", ""), ("olx", "a"), (None, "b")], "portal string, external_id string")
    profile.append_profile(df, path, "1")
    profile.append_profile(df.limit(0), path, "2")
    got = {r.portal: (r.distinct_ids, r.n_rows) for r in profile.merged_profile(spark, path).collect()}
    assert got == {"olx": (1, 1), None: (1, 1)}
