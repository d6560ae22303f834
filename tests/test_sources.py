from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cohortgram import ReportWindow
from cohortgram.functions.schemas import all_strings
from cohortgram.plans.storage import Scratch, scratch_root
from cohortgram.sources import export, raw
from cohortgram.sources.seeds import SEED_COLUMNS, Seeds, load_seed
from cohortgram.streaming import load_new_files

SCHEMA = all_strings("a", "b")
GOOD = 'a,b\n1,"x, y"\n2,"say ""hi"""\n3,"two\nlines"\n4, Null \n'


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "one.csv").write_text(GOOD)
    return folder


def test_load_keeps_text_as_it_is(spark, landing):
    frame = raw.load_raw(spark, str(landing), SCHEMA, "v1", multi_line=True)
    assert {r.a: r.b for r in frame.collect()} == {"1": "x, y", "2": 'say "hi"', "3": "two\nlines", "4": " Null "}
    row = frame.first()
    assert row.source_version == "v1" and row.source_file.endswith("one.csv") and row.ingested_at is not None
    assert dict(frame.dtypes)["a"] == "string"


def test_short_row_fails_the_load(spark, landing):
    (landing / "two.csv").write_text("a,b\n1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        raw.load_raw(spark, str(landing), SCHEMA, "v1").collect()


def test_a_break_in_quotes_needs_multi_line(spark, landing):
    with pytest.raises(Exception, match="MALFORMED"):
        raw.load_raw(spark, str(landing), SCHEMA, "v1").collect()


def test_columns_are_taken_by_header_name(spark, tmp_path):
    (tmp_path / "other.csv").write_text("b,extra,a\nB,X,A\n")
    row = raw.load_raw(spark, str(tmp_path), SCHEMA, "v1").first()
    assert (row.a, row.b) == ("A", "B") and "extra" not in row


def test_a_renamed_column_fails(spark, tmp_path):
    (tmp_path / "other.csv").write_text("a,c\n1,2\n")
    with pytest.raises(ValueError, match="no column b"):
        raw.load_raw(spark, str(tmp_path), SCHEMA, "v1")


def test_files_of_one_load_share_a_header(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.load_raw(spark, str(tmp_path), SCHEMA, "v1").collect()


def test_append_opens_new_files_only(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,x\n")
    loaded = spark.createDataFrame([(f"file:{tmp_path}/one.csv",)], "source_file string")
    # Not readable as CSV any more: opening it would fail the load.
    (tmp_path / "one.csv").write_text("a,b\n1\n")
    (tmp_path / "two.csv").write_text("b,a\nz,9\n")
    incoming = raw.append_new_files(spark, str(tmp_path), SCHEMA, "v2", loaded)
    assert [(r.a, r.b, r.source_version) for r in incoming.collect()] == [("9", "z", "v2")]
    everything = raw.file_names(spark, str(tmp_path))
    nothing = raw.append_new_files(spark, str(tmp_path), SCHEMA, "v3", everything)
    assert nothing.count() == 0 and nothing.columns == incoming.columns


def test_streamed_load_is_incremental(spark, landing, tmp_path):
    def load():
        query = load_new_files(
            spark, str(landing), SCHEMA, "v1", f"{tmp_path}/table", f"{tmp_path}/progress", multi_line=True
        )
        query.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/table").count()

    assert load() == 4
    assert load() == 4
    (landing / "two.csv").write_text("a,b\n9,z\n")
    assert load() == 5


def test_streamed_load_takes_columns_by_name(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "one.csv").write_text("b,a\nB,A\n")
    paths = (f"{tmp_path}/table", f"{tmp_path}/progress")
    load_new_files(spark, f"{tmp_path}/landing", SCHEMA, "v1", *paths).awaitTermination()
    assert spark.read.parquet(paths[0]).select("a", "b").first() == ("A", "B")
    (tmp_path / "landing" / "two.csv").write_text("a,b\nA,B\n")
    query = load_new_files(spark, f"{tmp_path}/landing", SCHEMA, "v1", *paths)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()


def test_row_count_check(spark):
    result = raw.row_count_check(
        {"x": spark.range(3), "y": spark.range(4)},
        spark.createDataFrame([("x", 3), ("y", 5)], "table_name string, expected_rows long"),
    )
    got = {r.table_name: (r.difference, r.row_count_check) for r in result.collect()}
    assert got == {"x": (0, "PASS"), "y": (-1, "CHECK")}


def test_inventory(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    text = "a,b,a,\n1,2,3,4\n,,,\n1,2\n"
    (folder / "odd.csv").write_text(text)
    row = raw.source_inventory(spark, str(folder), all_strings("a", "b", "c", "d"), "*.csv").first()
    assert row.size_bytes == len(text) and row.line_count == 4
    assert (row.data_row_count, row.column_count, row.empty_record_count, row.field_count_error_count) == (3, 4, 1, 1)
    assert row.duplicate_column_names == ["a"] and row.blank_column_positions == [4]


def test_inventory_reads_quotes(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,"b,x",c\n1,"two\nlines",3\n4,5,6\n')
    schema = all_strings("a", "b", "c")
    row = raw.source_inventory(spark, str(tmp_path), schema, "*.csv", multi_line=True).first()
    assert row["columns"] == ["a", "b,x", "c"] and (row.data_row_count, row.field_count_error_count) == (2, 0)


def test_fingerprint_follows_the_lines(spark, tmp_path):
    for name, text in (("one", "a\n1\n2\n"), ("same", "a\n1\n2\n"), ("other", "a\n1\n3\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    found = {r.path.rsplit("/", 1)[1]: r.line_fingerprint for r in raw.line_inventory(spark, str(tmp_path)).collect()}
    assert found["one.csv"] == found["same.csv"] != found["other.csv"]


def test_seed_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "g.csv").write_text("gram_stain_group,organism_reporting_group\ngram_positive,X\n")
    assert load_seed(spark, "organism_reporting_groups", str(tmp_path)).first() == ("X", "gram_positive")


def test_seeds_survive_csv(spark, tmp_path, rows):
    built_in = Seeds.built_in(spark)
    frames = (built_in.labels, built_in.groups, built_in.pairs, built_in.exclusions)
    for name, frame in zip(SEED_COLUMNS, frames):
        export.write_csv(frame, f"{tmp_path}/{name}.csv")
    loaded = Seeds.from_csv(spark, str(tmp_path))
    for ours, theirs in zip(frames, (loaded.labels, loaded.groups, loaded.pairs, loaded.exclusions)):
        assert rows(ours) == rows(theirs)


def test_exported_windows_stay_apart(spark, tmp_path):
    def mart(window, n):
        return spark.range(n).select("id", *window.columns())

    path = f"{tmp_path}/export"
    export.export_mart(mart(ReportWindow(date(2023, 1, 1)), 3), path)
    export.export_mart(mart(ReportWindow(), 5), path)
    export.export_mart(mart(ReportWindow(date(2023, 1, 1)), 2), path)
    counts = {str(r[export.WINDOW_PARTITION]): r["count"] for r in spark.read.parquet(path).groupBy(export.WINDOW_PARTITION).count().collect()}
    assert counts == {"2023-01-01": 2, export.FULL_RELEASE: 5}


def test_scratch_uses_the_configured_folder(spark, tmp_path):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    scratch = Scratch(spark, str(tmp_path))
    kept = scratch.keep("t", spark.range(3).select(F.col("id").alias("x")))
    assert scratch.path.startswith(str(tmp_path)) and kept.count() == 3
    assert Scratch(spark, str(tmp_path)).path != scratch.path


class _Session:
    """A session without a checkpoint folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

def test_no_folder_to_fall_back_to():
    with pytest.raises(RuntimeError):
        scratch_root(_Session)
