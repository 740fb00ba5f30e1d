"""Command-line runs over the generated test data."""

import os
import tempfile

import pytest

from ordertally import cli

SF = "/root/testdata/sf0.001"


def test_weekly_run_writes_all_reports(spark, capsys):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    code = cli.main(["weekly", "--fixtures", SF, "--out", out, "--start", "1996-01-01", "--end", "1996-06-30",
                     "--cutoff", "1996-05-01", "--format", "csv"], spark=spark)
    assert code == 0
    written = sorted(os.listdir(out))
    assert len(written) == 12 and all(w.endswith("_1996-01-01_to_1996-06-30") for w in written)
    assert "new_customers" in capsys.readouterr().out


def test_weekly_default_period_is_last_seven_days(spark):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    assert cli.main(["weekly", "--fixtures", SF, "--out", out, "--today", "1996-03-10"], spark=spark) == 0
    assert all(w.endswith("_1996-03-03_to_1996-03-10") for w in os.listdir(out))


def test_daily_range_text_and_detail(spark):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    assert cli.main(["daily", "--fixtures", SF, "--out", out, "--range", "250298-160398"], spark=spark) == 0
    assert os.path.isdir(os.path.join(out, "daily_product_totals_1998-02-25_to_1998-03-16"))
    assert cli.main(["detail", "--fixtures", SF, "--out", out, "--today", "1998-02-26"], spark=spark) == 0
    assert os.path.isdir(os.path.join(out, "daily_detail_1998-02-25"))


@pytest.mark.parametrize("text", ["310298", "160398-250298", "junk"])
def test_daily_rejects_bad_ranges(spark, text):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    assert cli.main(["daily", "--fixtures", SF, "--out", out, "--range", text], spark=spark) == 2


def test_stage_then_run_from_staged_tables(spark):
    from tables import D, make_tables

    t = make_tables(
        spark,
        orders=[{"id": i, "delivery_date": D(f"2025-01-0{1 + i % 5}"), "customer_id": i % 3} for i in range(1, 30)],
        lines=[{"order_id": i, "product_id": 1 + i % 2} for i in range(1, 30)],
    )
    plain = tempfile.mkdtemp(prefix="ordertally-plain-")
    for name, df in t.items():
        df.write.parquet(os.path.join(plain, name))
    staged = tempfile.mkdtemp(prefix="ordertally-staged-")
    assert cli.main(["stage", "--tables", plain, "--out", staged], spark=spark) == 0
    assert os.path.isdir(os.path.join(staged, "order_product", "delivery_date=2025-01-02"))
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    assert cli.main(["weekly", "--tables", staged, "--out", out, "--start", "2025-01-01",
                     "--end", "2025-01-07"], spark=spark) == 0
    assert len(os.listdir(out)) == 12
    got = spark.read.parquet(os.path.join(out, "packing_orders_2025-01-01_to_2025-01-07"))
    assert got.count() == 29


def test_connection_settings_map_to_jdbc_urls():
    from ordertally.sources.jdbc import settings_to_jdbc

    base = {"DB_USERNAME": "u", "DB_PASSWORD": "p", "DB_HOST": "db", "DB_PORT": "5432", "DB_NAME": "shop"}
    url, props = settings_to_jdbc({**base, "DB_DRIVER": "postgresql+psycopg2"})
    assert url == "jdbc:postgresql://db:5432/shop" and props == {"user": "u", "password": "p"}
    assert settings_to_jdbc({**base, "DB_DRIVER": "mysql+pymysql"})[0] == "jdbc:mysql://db:5432/shop"
    assert settings_to_jdbc({**base, "DB_DRIVER": "mssql+pyodbc"})[0] == "jdbc:sqlserver://db:5432;databaseName=shop"
    with pytest.raises(ValueError, match="DB_PASSWORD, DB_HOST"):
        settings_to_jdbc({"DB_DRIVER": "mysql", "DB_USERNAME": "u", "DB_PORT": "1", "DB_NAME": "x"})
    with pytest.raises(ValueError, match="unsupported"):
        settings_to_jdbc({**base, "DB_DRIVER": "oracle"})


def test_cli_refuses_to_start_without_settings(spark, monkeypatch, capsys):
    for k in ("DB_DRIVER", "DB_USERNAME", "DB_PASSWORD", "DB_HOST", "DB_PORT", "DB_NAME"):
        monkeypatch.delenv(k, raising=False)
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    assert cli.main(["weekly", "--db-env", "--out", out], spark=spark) == 2
    assert "missing connection settings" in capsys.readouterr().err


def test_weekly_run_with_per_report_periods(spark):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    code = cli.main(["weekly", "--fixtures", SF, "--out", out, "--start", "1996-01-01", "--end", "1996-06-30",
                     "--period-for", "yearly_orders=1996-01-01:1996-12-31",
                     "--period-for", "second_month_orders=1996-02-01:1996-02-29"], spark=spark)
    assert code == 0
    written = set(os.listdir(out))
    assert "yearly_orders_1996-01-01_to_1996-12-31" in written
    assert "second_month_orders_1996-02-01_to_1996-02-29" in written
    assert "customer_orders_1996-01-01_to_1996-06-30" in written
    year = spark.read.parquet(os.path.join(out, "yearly_orders_1996-01-01_to_1996-12-31")).count()
    half = spark.read.parquet(os.path.join(out, "customer_orders_1996-01-01_to_1996-06-30")).count()
    assert year > half > 0
    assert cli.main(["weekly", "--fixtures", SF, "--out", out, "--period-for", "nope=1:2"], spark=spark) == 2


@pytest.mark.parametrize("extra", [["--end", "1996-06-30"], ["--cutoff", "1996-05-01"]])
def test_dates_without_a_start_are_refused(spark, extra, capsys):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    assert cli.main(["weekly", "--fixtures", SF, "--out", out, *extra], spark=spark) == 2
    assert "--start" in capsys.readouterr().err and not os.listdir(out)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_daily_run_in_every_format(spark, fmt, capsys):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    args = ["daily", "--fixtures", SF, "--out", out, "--range", "250298-160398", "--format", fmt]
    assert cli.main(args, spark=spark) == 0
    assert "days without data: " in capsys.readouterr().out


def test_headers_are_the_display_names(spark):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")
    args = ["weekly", "--fixtures", SF, "--out", out, "--start", "1996-01-01", "--end", "1996-06-30", "--headers"]
    assert cli.main(args, spark=spark) == 0
    got = spark.read.parquet(os.path.join(out, "missing_lines_1996-01-01_to_1996-06-30")).columns
    assert "missing quantity" in got and "missing_quantity" not in got
    assert cli.main(["daily", "--fixtures", SF, "--out", out, "--range", "250298", "--headers"], spark=spark) == 0
    got = spark.read.parquet(os.path.join(out, "daily_product_totals_1998-02-25_to_1998-02-25")).columns
    assert "Total_Supplied" in got


def test_detail_run_leaves_an_error_table(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="ordertally-cli-")

    def broken(*a):
        raise RuntimeError("x" * 5000)

    monkeypatch.setattr(cli, "daily_detail", broken)
    assert cli.main(["detail", "--fixtures", SF, "--out", out, "--day", "1998-02-25"], spark=spark) == 1
    row = spark.read.parquet(os.path.join(out, "daily_detail_1998-02-25")).first()
    assert row.error == "RuntimeError: " + "x" * 5000


def test_checkpoint_folder_is_required_off_local():
    from ordertally.session import ensure_checkpoint_dir

    class Unset:
        conf = {}
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Unset)
