"""Multi-line exports in byte ranges against Spark's own multi-line reader, and headers."""

import random
import threading

import pytest

from surveylake.session import settings
from surveylake.sources import bronze
from surveylake.sources.split_csv import records, read_split_csv

SMALL_RANGES = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}


def field(rng):
    kind = rng.random()
    if kind < 0.35:
        text = "".join(rng.choice(["a", "é", " ", ",", "\n", '"', "\n\n", "b,c", "\r\n"]) for _ in range(rng.randint(0, 9)))
        return '"' + text.replace('"', '""') + '"'
    if kind < 0.5:
        return rng.choice(['5" screen', 'x"', 'a""b', "", " ", "'", 'say "hi" now'])
    return "".join(rng.choice("abcdefgé ") for _ in range(rng.randint(0, 12)))


def multi_line(spark, paths, n):
    return bronze.read_survey_csv(spark, paths, columns=n)


def rows(df, n):
    return sorted((tuple(r) for r in df.select(*(f"c{i}" for i in range(n))).collect()), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_are_those_of_the_multi_line_reader(spark, tmp_path, end):
    rng = random.Random(len(end))
    paths = []
    for number in range(4):
        # Spark's reader takes the first line end it meets, quoted or not, for those of the file.
        lines = ['id,"two\nlines",c' if end == "\n" else "id,two,c"]
        for i in range(120):
            lines.append(f"{number}-{i}," + ",".join(field(rng) for _ in range(rng.choice((2, 2, 2, 1, 3)))))
            if rng.random() < 0.1:
                lines.append("")
        path = tmp_path / f"e{number}.csv"
        path.write_text(end.join(lines) + rng.choice(["", end]), encoding="utf-8", newline="")
        paths.append(str(path))
    want = rows(multi_line(spark, paths, 3), 3)
    with settings(spark, SMALL_RANGES):
        split = read_split_csv(spark, paths, 3)
        assert records(spark, paths).sparkSession is spark
        assert spark.read.text(paths).rdd.getNumPartitions() > 40
        assert rows(split, 3) == want
    assert rows(read_split_csv(spark, paths, 3), 3) == want and len(want) == 480


def test_one_record_over_many_ranges(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text('a,b\n1,"' + "line\n" * 300 + '"\n2,x\n', encoding="utf-8")
    with settings(spark, SMALL_RANGES):
        assert rows(read_split_csv(spark, [str(path)], 2), 2) == [("1", "line\n" * 300), ("2", "x")]


def test_an_unclosed_quote_is_an_error_that_names_the_file(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('a,b\n1,"' + "x\n" * 500, encoding="utf-8")
    with pytest.raises(Exception, match="open.csv"):
        read_split_csv(spark, [str(path)], 2, longest=400).collect()


HEADS = [
    'id,5" screen,job\n1,2,3\n4,"x\n",6\n', 'id,"a ""b"" c","d,e"\n1,2,3\n', 'id,"two\nlines",c\n1,2,3\n', "id,b,c\r\n1,2,3\r\n",
    '\n\nid,b,c\n1,2,3\n', "id,b,\n1,2,3\n", "id,,c\n1,2,3", 'id,x"y"z,"q"\n1,2,3\n', "só,é,ü\n1,2,3\n",
]


@pytest.mark.parametrize("text", HEADS)
def test_headers_are_those_of_sparks_reader(spark, tmp_path, text, monkeypatch):
    monkeypatch.setattr(bronze, "HEADER_BYTES", 4)
    path = tmp_path / "h.csv"
    path.write_text(text, encoding="utf-8", newline="")
    raw = spark.read.option("multiLine", True).option("quote", '"').option("escape", '"').csv(str(path)).first()
    assert bronze.read_header(spark, str(path)) == [value or "" for value in raw]


def test_headers_are_bounded(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text('id,"never closed\n' + "1,2\n" * 2000, encoding="utf-8")
    with pytest.raises(ValueError, match="h.csv"):
        bronze.read_header(spark, str(path), longest=1000)
    (tmp_path / "empty.csv").write_text("")
    assert bronze.read_header(spark, str(tmp_path / "empty.csv")) == []
    (tmp_path / "line.csv").write_text("only,this")
    assert bronze.read_header(spark, str(tmp_path / "line.csv")) == ["only", "this"]


def test_large_exports_are_split_on_the_way_to_bronze(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    body = "".join(f'{i},"um\n{i}"\n' for i in range(200))
    (tmp_path / "raw" / "pesquisa_2023.csv").write_text("0.a_token,9.z_comentario\n" + body, encoding="utf-8")
    found = {}
    for name, split_from in (("whole", bronze.SPLIT_FROM), ("split", 100)):
        report = bronze.ingest(spark, str(tmp_path / "raw"), str(tmp_path / name), split_from=split_from)
        assert report == {2023: {"rows": 200, "columns": 5}}
        found[name] = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / name)).drop("ingerido_em").collect())
    assert found["whole"] == found["split"]


def test_editions_are_written_side_by_side_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    """One task reads a whole export, so neither the other exports nor the tasks after it wait for it."""
    for year in (2023, 2024):
        folder = tmp_path / "raw" / f"survey_{year}.csv"
        spark.range(25).selectExpr("cast(id as string) as p1", f"'{year}' as p2").coalesce(1).write.option("header", True).csv(str(folder))
    both, observation = threading.Barrier(2, timeout=30), bronze.Observation

    def observed():
        both.wait()
        return observation()

    monkeypatch.setattr(bronze, "Observation", observed)
    monkeypatch.setattr(bronze, "ROWS_PER_FILE", 10, raising=False)
    report = bronze.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"))
    assert report == {2023: {"rows": 25, "columns": 5}, 2024: {"rows": 25, "columns": 5}}
    for year in (2023, 2024):
        assert len(list((tmp_path / "bronze" / f"survey_year={year}").glob("*.parquet"))) == 3
        assert bronze.read_edition(spark, str(tmp_path / "bronze"), year).count() == 25
