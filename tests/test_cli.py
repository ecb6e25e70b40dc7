"""Command line: settings checked first, jobs end to end on topic tables, exit status 1 on errors."""

import json

import pytest

from tracelake.cli import ingest_label, main, run

from test_logparse import SEVEN


def test_missing_settings_fail_before_spark(monkeypatch, capsys):
    monkeypatch.delenv("KAFKA_BROKERS", raising=False)
    monkeypatch.delenv("KAFKA_TOPIC", raising=False)
    assert main(["logs-to-topic", "--log-file", "x.trc"]) == 1
    assert "KAFKA_BROKERS" in capsys.readouterr().err


def test_missing_log_file_exits_1(spark, tmp_path, capsys):
    assert main(["logs-to-topic", "--log-file", str(tmp_path / "nope.trc"), "--topic-path", str(tmp_path / "t")]) == 1
    assert "PATH_NOT_FOUND" in capsys.readouterr().err


def test_three_jobs_chain(spark, tmp_path):
    f = tmp_path / "sample.trc"
    f.write_text(SEVEN)
    topic = str(tmp_path / "topic")
    assert run(["logs-to-topic", "--log-file", str(f), "--topic-path", topic, "--topic", "logs"]) == {"lines": 7, "rows": 7, "rejected": 0, "messages": 1}
    out = run(["topic-to-table", "--topic-path", topic, "--table-path", str(tmp_path / "table"),
               "--checkpoint", str(tmp_path / "chk")])
    label = ingest_label(str(tmp_path / "chk"))
    assert out == {"ingest": label, "batches": 1, "messages": 1, "rows": 7, "rejected": 0}
    again = run(["topic-to-table", "--topic-path", topic, "--table-path", str(tmp_path / "table"),
                 "--checkpoint", str(tmp_path / "chk")])
    assert again == {"ingest": label, "batches": 0, "messages": 0, "rows": 0, "rejected": 0}
    assert spark.read.parquet(str(tmp_path / "table")).count() == 7

    spark.createDataFrame([(" 1", "User1 "), ("2", "User2")], "ID string, NAME string").createOrReplaceTempView("cli_users")
    users_topic = str(tmp_path / "users")
    assert run(["table-to-topic", "--table", "cli_users", "--topic-path", users_topic]) == {"rows": 2}
    values = [bytes(m.value).decode() for m in spark.read.parquet(users_topic).collect()]
    rows = sorted((r for v in values for r in json.loads(v)), key=lambda r: r["id"])
    assert rows == [{"id": 1, "name": "User1"}, {"id": 2, "name": "User2"}]
    assert all(v.startswith('[{"id":') and " " not in v for v in values)


def test_jdbc_source_error_exits_1(spark, tmp_path, capsys):
    # a URL no JDBC driver accepts: nothing is started or contacted
    code = main(["table-to-topic", "--jdbc-url", "jdbc:nosuchdriver://nowhere/db", "--jdbc-table", "USERS",
                 "--topic-path", str(tmp_path / "t")])
    assert code == 1
    assert "tracelake:" in capsys.readouterr().err


def test_quarantine_needs_a_place(tmp_path):
    from tracelake.cli import run

    with pytest.raises(ValueError, match="--quarantine"):
        run(["topic-to-table", "--topic-path", "t", "--table-path", "p", "--checkpoint", "c", "--on-error", "quarantine"])


def test_two_checkpoints_of_one_name_load_side_by_side(spark, tmp_path):
    for name in ("a", "b"):
        f = tmp_path / f"{name}.trc"
        f.write_text(SEVEN)
        topic = str(tmp_path / name / "topic")
        run(["logs-to-topic", "--log-file", str(f), "--topic-path", topic, "--topic", "logs"])
        run(["topic-to-table", "--topic-path", topic, "--table-path", str(tmp_path / "table"), "--checkpoint", str(tmp_path / name / "chk") + "/"])
    assert spark.read.parquet(str(tmp_path / "table")).count() == 14
    assert ingest_label("/a/chk") == ingest_label("/a/chk/") != ingest_label("/b/chk")
