"""Row sets and small address dumps for the tests."""

import datetime as dt
from collections import Counter

from tidemark import ADDRESS_SCHEMA

HEADER = ";".join(ADDRESS_SCHEMA.fieldNames())


def day(n):
    return dt.date(2025, 1, n)


def bag(df):
    """The rows as a multiset, columns in name order."""
    columns = sorted(df.columns)
    return Counter(tuple(repr(r[c]) for c in columns) for r in df.collect())


def same(a, b):
    return sorted(a.columns) == sorted(b.columns) and bag(a) == bag(b)


def address(number, street="Rue du Four", code="s1", insee="01001", **values):
    """One address as a full row."""
    row = dict.fromkeys(ADDRESS_SCHEMA.fieldNames())
    row.update(
        uid_adresse=f" @a:{code}-{number}",
        cle_interop=f"{insee}_{code}_{number:05d}",
        commune_insee=insee,
        commune_nom="Ville-d'Été",
        voie_nom=street,
        numero=number,
        x=848000.5 + number,
        y=6561000.25,
        long=4.9,
        lat=46.1,
        source="cadastre",
        certification_commune=0,
    )
    row.update(values)
    return row


def base_addresses():
    """15 rows in 4 streets of one commune; the 8 that stay on the short day are in 3."""
    streets = [("Chemin Vert", "a1", 1), ("Place Haute", "b1", 1), ("Rue du Four", "c1", 10), ("Route Longue", "d1", 3)]
    return [
        address(i + 1, street=name, code=code) for name, code, n in streets for i in range(n)
    ]


def short_addresses():
    rows = base_addresses()
    return [rows[1]] + rows[2:7] + rows[12:14]


def frame(spark, rows):
    names = ADDRESS_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ADDRESS_SCHEMA)


def csv_line(row):
    return ";".join("" if row[n] is None else str(row[n]) for n in ADDRESS_SCHEMA.fieldNames())


def write_csv(path, rows, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [header, *[r if isinstance(r, str) else csv_line(r) for r in rows], ""]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)
