"""The jobs as a user starts them."""

import pytest
from samples import order

from retailflow.__main__ import arguments, main
from retailflow.tables import Tables


def test_a_day_of_jobs(spark, tmp_path, capsys):
    root = str(tmp_path / "tables")
    inbox = tmp_path / "inbox" / "transactions"
    inbox.mkdir(parents=True)
    lines = [order(quantity=150), order(order_id="o2", timestamp="2023-01-01T00:00:00+00:00")]
    (inbox / "1").write_text("\n".join(lines))
    places = tmp_path / "c.csv"
    places.write_text("city,state,latitude,longitude\nAustin,TX,30.25,-97.75\n")

    def run(*words):
        main([words[0], "--root", root, *words[1:]])
        return capsys.readouterr().out.strip()

    inputs = ("--files", str(tmp_path / "inbox"), "--kinds", "transactions", "--limit", "1")
    run("stream", *inputs, "--running", "--state-partitions", "2")
    assert (inbox / "1").exists()  # two queries read it
    assert run("load-coordinates", "--csv", str(places)) == "1"
    as_of = ("--as-of", "2024-03-01T15:00:00")
    assert run("summary", *as_of) == "2024-03-01\t1\t150\t1875.0\t1"
    assert "New total orders today: 1 <br>" in run("activity", *as_of)
    assert run("alert", *as_of) == "1"
    assert run("alert", "--threshold", "150", *as_of) == "1"
    bodies = [row["body"] for row in Tables(spark, root).read("alerts").collect()]
    assert sorted(body.split(",")[0] for body in bodies) == [
        "No suspicious orders detected today.",
        "Order ID: o1",
    ]
    run("compact")
    assert run("archive", *as_of) == "0"
    assert run("summary", *as_of) == "2024-03-01\t1\t150\t1875.0\t1"


def test_files_move_and_the_merged_summary(spark, tmp_path, capsys):
    root, inbox = str(tmp_path / "tables"), tmp_path / "inbox" / "transactions"
    inbox.mkdir(parents=True)
    for number in range(3):
        (inbox / str(number)).write_text(order(order_id=f"o{number % 2}", quantity=number + 1))
        main(["stream", "--root", root, "--files", str(tmp_path / "inbox"), "--kinds", "transactions", "--daily-keys"])
    assert not (inbox / "0").exists() and not (inbox / "1").exists()
    for more in ([], ["--merged"]):
        main(["summary", "--root", root, "--as-of", "2024-03-01T15:00:00", *more])
    first, second = capsys.readouterr().out.strip().splitlines()
    assert first == second == "2024-03-01\t2\t6\t75.0\t1"
    assert Tables(spark, root).read("stream_progress").filter("event = 'stopped'").count() == 3


def test_a_source_is_needed():
    with pytest.raises(SystemExit):
        arguments(["stream", "--root", "x"])
