"""CSV dumps: malformed lines, moved or missing columns, odd paths."""

import pytest

from tidemark import ADDRESS_SCHEMA, conform, dump_path, read_dump

from .helpers import HEADER, address, csv_line, day, frame, same, write_csv


def test_reads_as_declared(spark, tmp_path):
    rows = [address(1), address(2, insee="2A001"), address(3, insee="97105")]
    df = read_dump(spark, write_csv(tmp_path / "d.csv", rows))
    assert df.schema == ADDRESS_SCHEMA
    assert same(df, frame(spark, rows))
    got = {r["numero"]: r for r in df.collect()}
    assert got[1]["uid_adresse"].startswith(" @a:")
    assert [got[n]["commune_insee"] for n in (1, 2, 3)] == ["01001", "2A001", "97105"]


def test_malformed_lines(spark, tmp_path):
    good = csv_line(address(1))
    short = ";".join(csv_line(address(2)).split(";")[:3])
    long = csv_line(address(3)) + ";surplus"
    df = read_dump(spark, write_csv(tmp_path / "d.csv", [good, "", short, long]))
    got = {r["cle_interop"]: r for r in df.collect()}
    assert len(got) == 3
    assert got["01001_s1_00002"]["numero"] is None
    assert got["01001_s1_00002"]["commune_insee"] == "01001"
    assert got["01001_s1_00003"]["certification_commune"] == 0


def test_quoted_values(spark, tmp_path):
    line = csv_line(address(1, voie_nom="X")).replace(";X;", ';"Rue; dite ""Haute""";')
    header_check = read_dump(spark, write_csv(tmp_path / "d.csv", [line]))
    assert header_check.first()["numero"] == 1


def test_unreadable_number_is_null_and_spoils_nothing(spark, tmp_path):
    bad = csv_line(address(1)).replace(";1;", ";one;")
    rows = read_dump(spark, write_csv(tmp_path / "d.csv", [bad, csv_line(address(2))])).collect()
    assert {r["cle_interop"]: r["numero"] for r in rows} == {"01001_s1_00001": None, "01001_s1_00002": 2}
    with pytest.raises(Exception):
        read_dump(spark, str(tmp_path / "d.csv"), mode="FAILFAST").collect()


def test_columns_go_by_name(spark, tmp_path):
    names = ["numero", "extra", "cle_interop", "commune_insee"]
    path = write_csv(tmp_path / "d.csv", ["7;?;key;01001"], header=";".join(names))
    row = read_dump(spark, path).first()
    assert (row["numero"], row["cle_interop"], row["commune_insee"], row["voie_nom"]) == (7, "key", "01001", None)
    assert read_dump(spark, path).schema == ADDRESS_SCHEMA


def test_no_known_column_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "d.csv", ["1,2"], header=HEADER.replace(";", ","))
    with pytest.raises(ValueError):
        read_dump(spark, path)


def test_files_of_one_dump_must_agree(spark, tmp_path):
    write_csv(tmp_path / "d" / "1.csv", ["1;a"], header="numero;cle_interop")
    write_csv(tmp_path / "d" / "2.csv", ["b;2"], header="cle_interop;numero")
    with pytest.raises(Exception):
        read_dump(spark, str(tmp_path / "d")).collect()


def test_where_a_dump_lies(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        dump_path(spark, folder, day(1))
    nested = write_csv(tmp_path / f"dump-{day(1)}" / "adresses.csv", [address(1)])
    assert dump_path(spark, folder, day(1)) == nested
    single = write_csv(tmp_path / f"dump-{day(1)}.csv", [address(1)])
    assert dump_path(spark, folder, "2025-01-01") == single


def test_conform(spark):
    df = frame(spark, [address(1)])
    assert conform(df.drop("suffixe"), ADDRESS_SCHEMA, ["cle_interop"]).columns == df.columns
    for wrong, error in (
        (df.drop("cle_interop"), ValueError),
        (df.withColumn("numero", df.numero.cast("double")), TypeError),
        (df.withColumn("more", df.numero), ValueError),
    ):
        with pytest.raises(error):
            conform(wrong, ADDRESS_SCHEMA, ["cle_interop"])
    extra = df.withColumn("more", df.numero)
    assert conform(extra, ADDRESS_SCHEMA, ["cle_interop"], extra="drop").columns == df.columns
