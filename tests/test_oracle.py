"""Registered queries against their oracle SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entrada
from verificar import _filas

CONSULTAS, ORACULOS = entrada.queries(), entrada.oracle_sql()
# graph iterations are compared with brute force on small graphs in their own tests
LENTAS = ("g12", "g14", "g15", "g16", "g18", "g22", "g23", "g24", "g28", "g29", "g30", "r")
RAPIDAS = [n for n in CONSULTAS if n in ORACULOS and not n.startswith(LENTAS)]


@pytest.fixture(scope="module")
def con(carpeta):
    c = duckdb.connect()
    for p in glob.glob(os.path.join(carpeta, "*.parquet")):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("nombre", RAPIDAS)
def test_consulta(spark, con, carpeta, nombre):
    tabla = CONSULTAS[nombre](spark, carpeta).toArrow()
    esperada = con.sql(ORACULOS[nombre]).to_arrow_table()
    assert sorted(tabla.column_names) == sorted(esperada.column_names)
    assert _filas(tabla) == _filas(esperada)


def test_entry(spark):
    assert entrada.entry(spark).count() > 0


def test_cada_oraculo_tiene_consulta():
    assert set(ORACULOS) <= set(CONSULTAS)
