from __future__ import annotations

import datetime
import random
import uuid

import pytest
from conftest import rows
from pyspark.errors import PySparkException

from ledgerloom.functions import scalar as S
from ledgerloom.plans import ingest as flow
from ledgerloom.sources import flatfile, sinks


def vendor_text(fields, data, before="START-OF-FILE\nPROGRAM=x|y|\n", after="trailer|1|\n"):
    lines = ["START-OF-FIELDS", *fields, "END-OF-FIELDS", "between|1|", "START-OF-DATA", *data, "END-OF-DATA"]
    return before + "\n".join(lines) + "\n" + after + "END-OF-FILE\n"


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_values_and_sections(spark, tmp_path):
    path = write(
        tmp_path,
        "fundamentals_namr_bs.out.20250520",
        vendor_text(["A", "B"], ["s1|0|2|x|N.A.|", " s2|0|2||N.A. |  ", "s3|0|2|N.A.x| y |tail"]),
    )
    df = flatfile.read_flatfiles(spark, path)
    assert df.columns == ["SECURITY_DESCRIPTION", "RCODE", "NFIELDS", "A", "B", "OPERATION_DATE"]
    assert df.select("OPERATION_DATE").distinct().first()[0] == datetime.date.today()
    assert rows(df.drop("OPERATION_DATE"), "SECURITY_DESCRIPTION") == [
        ("s1", "0", "2", "x", None),
        ("s2", "0", "2", "", "N.A. "),
        ("s3", "0", "2", "N.A.x", " y "),
    ]


def test_modes(spark, tmp_path):
    path = write(tmp_path, "f.txt", vendor_text(["A"], ["s1|0|1|x|", "s2|0|", "s3|0|1|y|z|", ""]))
    with pytest.raises(PySparkException, match="row width differs"):
        flatfile.read_flatfiles(spark, path).collect()
    kept = flatfile.read_flatfiles(spark, path, "DROPMALFORMED", operation_date=False)
    assert rows(kept) == [("s1", "0", "1", "x")]
    padded = flatfile.read_flatfiles(spark, path, "PERMISSIVE", operation_date=False)
    assert rows(padded, "SECURITY_DESCRIPTION") == [
        (None, None, None, None),
        ("s1", "0", "1", "x"),
        ("s2", "0", None, None),
        ("s3", "0", "1", "y"),
    ]


def test_odd_files(spark, tmp_path):
    write(tmp_path, "empty.out", "")
    write(tmp_path, "nodata.out", "START-OF-FIELDS\nA\nEND-OF-FIELDS\n")
    write(tmp_path, "open.out", "START-OF-FIELDS\nA\nEND-OF-FIELDS\nSTART-OF-DATA\ns1|0|1|x|\n")
    write(
        tmp_path,
        "twice.out",
        "START-OF-FIELDS\nA\nEND-OF-FIELDS\nSTART-OF-DATA\ns2|0|1|y|\nEND-OF-FILE\nno|\nSTART-OF-DATA\ns3|0|1|z|\n",
    )
    df = flatfile.read_flatfiles(spark, str(tmp_path), operation_date=False)
    assert rows(df, "SECURITY_DESCRIPTION") == [("s1", "0", "1", "x"), ("s2", "0", "1", "y"), ("s3", "0", "1", "z")]


def test_field_name_with_delimiter(spark, tmp_path):
    path = write(tmp_path, "f.out", vendor_text(["A|1", "B"], ["s|0|2|x|y|"]))
    assert flatfile.read_flatfiles(spark, path).columns[3:5] == ["A|1", "B"]


def test_repeated_field_is_refused(spark, tmp_path):
    path = write(tmp_path, "f.out", vendor_text(["A", "A"], ["s|0|2|x|y|"]))
    with pytest.raises(ValueError, match="twice"):
        flatfile.read_flatfiles(spark, path)


def test_large_file_is_split_in_any_packing(spark, tmp_path, conf):
    """Small splits, several to a task: order inside a file must still hold."""
    rng = random.Random(3)
    want = []
    for k in range(4):
        fields = ["A", "B"] if k % 2 else ["B", "C", "D"]
        data = []
        for i in range(rng.randint(50, 200)):
            values = [f"{k}-{i}-{f}" for f in fields]
            data.append("|".join([f"s{k}-{i}", "0", str(len(fields)), *values]) + "|")
            named = dict(zip(fields, values))
            want.append((f"s{k}-{i}", *[named.get(c) for c in "ABCD"]))
        write(tmp_path, f"fundamentals_namr_t{k}.out", vendor_text(fields, data))
    for size, cost in ((150, 0), (300, 10), (1000, 0), (500, 2000)):
        conf("spark.sql.files.maxPartitionBytes", size)
        conf("spark.sql.files.openCostInBytes", cost)
        staged = flatfile.stage_lines(spark, str(tmp_path))
        conf("spark.sql.files.maxPartitionBytes", 128 << 20)
        blocks = staged.select("file", "pos.block").distinct().count()
        assert blocks > 20 or size == 1000
        got = flatfile.parse_rows(staged).select("SECURITY_DESCRIPTION", "A", "B", "C", "D")
        assert sorted(rows(got), key=str) == sorted(want, key=str)


def test_by_type_and_ingest(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    names = ["ID_BB_COMPANY", "FISCAL_YEAR_PERIOD", "FILING_STATUS", "EQY_CONSOLIDATED", "ACCOUNTING_STANDARD"]
    fields = [*names, "LATEST_PERIOD_END_DT_FULL_RECORD", "ANNOUNCEMENT_DT"]
    write(source, "fundamentals_namr_bs.out.1", vendor_text(fields, ["s|0|7|||MR|Y|US GAAP||20200102|"]))
    write(source, "fundamentals_euro_bs.out.2", vendor_text([*fields, "X"], ["t|0|8|c|2020 A||||20191231|99999999|9|"]))
    write(source, "fundamentals_namr_sard_is.out.1", vendor_text(fields, ["u|0|7|d|2020 A|N.A.|Y|x|20191231||"]))
    write(source, "fundamentals_namr_cf.out.1", vendor_text(fields, []))
    frames = flatfile.read_by_type(spark, str(source))
    assert sorted(frames) == ["bs", "sard_is"]
    assert "X" in frames["bs"].columns and frames["bs"].count() == 2

    registry = str(tmp_path / "registry")
    paths = flow.ingest_to(spark, str(source), str(out), registry, datetime.date(2025, 5, 20))
    assert paths == {k: f"{out}/fundamentals_{k}_20250520.parquet" for k in ("bs", "sard_is")}
    bs = spark.read.parquet(paths["bs"]).orderBy("SECURITY_DESCRIPTION").collect()
    day = datetime.date
    assert [(r.ID_BB_COMPANY, r.FISCAL_YEAR_PERIOD, r.FILING_STATUS) for r in bs] == [
        ("-1", "99999999", "MR"),
        ("c", "2020 A", "Unknown"),
    ]
    assert [(r.LATEST_PERIOD_END_DT_FULL_RECORD, r.ANNOUNCEMENT_DT) for r in bs] == [
        (None, day(2020, 1, 2)),
        (day(2019, 12, 31), None),
    ]
    known = spark.read.parquet(registry)
    assert {r.filename for r in known.collect()} == {
        "fundamentals_namr_bs.out",
        "fundamentals_euro_bs.out",
        "fundamentals_namr_sard_is.out",
        "fundamentals_namr_cf.out",
    }
    flow.ingest(spark, str(source), registry)
    assert spark.read.parquet(registry).count() == 4


@pytest.mark.parametrize(
    "name, want",
    [
        ("fundamentals_namr_bs.out.20250520", ("namr", "bs")),
        ("/a/b/fundamentals_namr_sard_is.out.20250520", ("namr", "sard_is")),
        ("c:\\x\\fundamentals_namr_bs_history.out", ("namr", "bs")),
        ("fundamentals_namr_sard_is_history.out", ("namr", "sard_is")),
        ("fundamentals_namr_bs_history.out.5", ("namr", "bs_history")),
        ("fundamentals_namr_sard_is_history.out.5", ("namr", "sard_is")),
        ("FUNDAMENTALS_namr_cr2.OUT", ("namr", "cr2")),
        ("other.txt", ("Unknown", "Unknown")),
    ],
)
def test_file_identity(spark, name, want):
    df = spark.createDataFrame([(name,)], "path string")
    assert tuple(df.select(S.file_region("path"), S.file_type("path")).first()) == want


def test_name_uuid(spark):
    names = ["abc", "fundamentals_namr_bs.out", "", "äöü"] + [f"n{i}" for i in range(100)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert all(r[1] == str(uuid.uuid3(uuid.NAMESPACE_DNS, r[0])) for r in df.select("n", S.name_uuid("n")).collect())


def test_registry_first_writer_wins(spark, tmp_path):
    path = str(tmp_path / "r")
    one = spark.createDataFrame([("x/fundamentals_a_bs.out.1", ["A"]), ("plain.txt", ["P"])], "path string, colnames array<string>")
    two = spark.createDataFrame([("y/fundamentals_a_bs.out.2", ["B"]), ("new.txt", ["N"])], one.schema)
    assert sinks.append_registry(spark, sinks.registry_rows(one), path).count() == 2
    assert [r.filename for r in sinks.append_registry(spark, sinks.registry_rows(two), path).collect()] == ["new.txt"]
    got = {r.filename: r.colnames for r in spark.read.parquet(path).collect()}
    assert got == {"fundamentals_a_bs.out": ["A"], "plain.txt": ["P"], "new.txt": ["N"]}
