"""Loads that end between write and commit, loads at once, and loads in several parts."""

import pytest

from cohortgram.functions.schemas import all_strings
from cohortgram.sources.ledger import CommitConflict, LoadLedger

SCHEMA = all_strings("a", "b")


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for i in range(5):
        (folder / f"{i}.csv").write_text("a,b\n" + "".join(f"{i},{k}\n" for k in range(i)))
    return folder


@pytest.fixture
def ledger(spark, tmp_path):
    return LoadLedger(spark, f"file://{tmp_path}/table", SCHEMA)


def state(ledger):
    return sorted(tuple(r) for r in ledger.rows().select("a", "b", "source_version").collect())


def expected(version, files=range(5)):
    return sorted((str(i), str(k), version) for i in files for k in range(i))


def test_every_file_once(ledger, landing):
    assert ledger.rows().count() == 0 and ledger.files().count() == 0
    assert len(ledger.load(str(landing), "v1")) == 1
    assert state(ledger) == expected("v1")
    # The first file has a header alone; it is in the ledger all the same.
    entries = {r.source_file.rsplit("/", 1)[1]: r for r in ledger.files().collect()}
    assert {n: r.row_count for n, r in entries.items()} == {f"{i}.csv": i for i in range(5)}
    assert all(r.size_bytes == (landing / n).stat().st_size and r.modified_at for n, r in entries.items())
    assert ledger.load(str(landing), "v2") == [] and state(ledger) == expected("v1")
    (landing / "9.csv").write_text("a,b\n9,0\n")
    assert len(ledger.load(str(landing), "v2")) == 1
    assert state(ledger) == sorted([*expected("v1"), ("9", "0", "v2")])


def test_parts_equal_the_whole(spark, tmp_path, landing, ledger):
    assert len(ledger.load(str(landing), "v1", files_per_load=2)) == 3
    whole = LoadLedger(spark, f"file://{tmp_path}/whole", SCHEMA)
    whole.load(str(landing), "v1")
    assert state(ledger) == state(whole)
    columns = ["source_file", "size_bytes", "modified_at", "row_count", "fingerprint"]
    found, other = (sorted(tuple(r) for r in x.files().select(*columns).collect()) for x in (ledger, whole))
    assert found == other


def test_a_load_that_dies_before_its_commit_leaves_nothing(ledger, landing, monkeypatch):
    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            ledger.load(str(landing), "dead")
    assert state(ledger) == [] and ledger.files().count() == 0
    ledger.load(str(landing), "v1")
    assert state(ledger) == expected("v1")
    assert ledger.clear_staged() == 0 and ledger.clear_staged(older_than_hours=0) == 1
    assert state(ledger) == expected("v1")


def test_a_load_that_dies_while_it_writes_entries_leaves_nothing(ledger, landing, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr("cohortgram.sources.ledger.ENTRY", "no_such_column string")
        with pytest.raises(Exception, match="no_such_column"):
            ledger.stage([tuple(r) for r in ledger.listed(str(landing)).collect()], "dead")
    assert state(ledger) == []
    ledger.load(str(landing), "v1")
    assert state(ledger) == expected("v1")


def test_of_two_loads_at_once_one_wins(ledger, landing):
    number = ledger.next_number()
    files = [tuple(r) for r in ledger.new_files(str(landing)).collect()]
    first, second = ledger.stage(files, "one"), ledger.stage(files, "two")
    ledger.commit(second, number)
    with pytest.raises(CommitConflict):
        ledger.commit(first, number)
    assert state(ledger) == expected("two")


def test_a_bad_file_fails_its_group_alone(ledger, landing):
    (landing / "3.csv").write_text("a,b\n1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        ledger.load(str(landing), "v1", files_per_load=1)
    assert state(ledger) == expected("v1", range(3))


def test_changed_files_are_reported_and_not_loaded(ledger, landing):
    ledger.load(str(landing), "v1")
    assert ledger.changed_files(str(landing)).count() == 0
    (landing / "2.csv").write_text("a,b\nnew,1\n")
    assert [r.source_file.rsplit("/", 1)[1] for r in ledger.changed_files(str(landing)).collect()] == ["2.csv"]
    ledger.load(str(landing), "v2")
    assert state(ledger) == expected("v1")


def test_loads_that_do_not_count_are_not_read(ledger, landing):
    files = [tuple(r) for r in ledger.listed(str(landing)).collect()]
    ledger.stage(files, "never")
    assert "dynamicpruning" in ledger.rows()._jdf.queryExecution().executedPlan().toString().lower()
