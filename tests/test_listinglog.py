"""Files found since the last look."""

from noticelake.sources.listinglog import ListingLog


def put(root, *names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("{}", encoding="utf-8")


def names(files):
    return sorted(r.path.rsplit("/", 1)[-1] for r in files.select("path").collect())


def test_only_new_folders_are_listed(spark, tmp_path):
    raw = tmp_path / "raw"
    log = ListingLog(spark, str(tmp_path / "log"), str(raw))
    put(raw, "2026-01-01/run_1.json", "2026-01-02/run_2.json", "2026-01-02/other.json", "_hidden/run_0.json", "run_9.json")
    first = log.look()
    assert first.folders == ["2026-01-01", "2026-01-02"] and names(first.files) == ["run_1.json", "run_2.json"]
    # Before a commit the same files are found again.
    assert names(log.look().files) == ["run_1.json", "run_2.json"] and log.mark() is None
    log.commit(first)
    assert log.mark() == "2026-01-02"
    again = log.look()
    assert again.folders == ["2026-01-02"] and names(again.files) == []
    # The folder of the mark grows, a new one comes, and a file arrives late in an old folder.
    put(raw, "2026-01-02/deep/run_3.json", "2026-01-03/run_4.json", "2026-01-01/run_5.json")
    second = log.look()
    assert second.folders == ["2026-01-02", "2026-01-03"] and names(second.files) == ["run_3.json", "run_4.json"]
    assert {(r.path.rsplit("/", 1)[-1], r.folder) for r in second.files.collect()} == {
        ("run_3.json", "2026-01-02"),
        ("run_4.json", "2026-01-03"),
    }
    log.commit(second)
    put(raw, "2026-01-03/run_6.json")
    log.commit(log.look())
    assert log.look().folders == ["2026-01-03"] and names(log.look().files) == []
    late = log.look(everything=True)
    assert len(late.folders) == 3 and names(late.files) == ["run_5.json"]
    log.commit(late)
    assert log.mark() == "2026-01-03" and names(log.look(everything=True).files) == []
    assert names(log.files()) == [f"run_{i}.json" for i in range(1, 7)]


def test_a_file_that_changed_is_found_again(spark, tmp_path):
    import os

    raw = tmp_path / "raw"
    log = ListingLog(spark, str(tmp_path / "log"), str(raw))
    put(raw, "a/run_1.json")
    log.commit(log.look())
    os.utime(raw / "a/run_1.json", (1_900_000_000, 1_900_000_000))
    assert names(log.look().files) == ["run_1.json"]


def test_nothing_there(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    log = ListingLog(spark, str(tmp_path / "log"), str(tmp_path / "raw"))
    found = log.look()
    assert found.folders == [] and found.files.count() == 0
    log.commit(found)
    assert log.mark() is None and log.files().count() == 0
