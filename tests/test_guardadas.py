"""Keyed merge into stored tables."""

import glob

import pytest
from pyspark.sql import functions as F

from comanda.sources import guardadas
from tests.conftest import filas

ESQUEMA = "k long, t string, v string"


def _archivos(ruta):
    return set(glob.glob(f"{ruta}/datos/*/*/part-*"))


def test_fusionar(spark, tmp_path):
    ruta = str(tmp_path / "tabla")
    base = [(k, "a", f"v{k}") for k in range(40)] + [(None, "a", "nula"), (None, None, "dos nulas")]
    df = spark.createDataFrame(base, ESQUEMA)
    assert guardadas.fusionar(df, ruta, ["k", "t"], cubetas=8) == 1
    antes = _archivos(ruta)
    # loading twice equals loading once, and writes nothing
    assert guardadas.fusionar(df.unionByName(df), ruta, ["k", "t"]) == 1 and _archivos(ruta) == antes
    assert filas(guardadas.leer(spark, ruta).fillna("-").fillna(-1)) == filas(df.fillna("-").fillna(-1))
    # one changed and one new key, told twice: the greatest counts, and only their buckets are written
    otra = spark.createDataFrame([(3, "a", "x"), (3, "a", "nuevo"), (None, None, None), (99, "b", "z"), (5, "a", "v5")], ESQUEMA)
    assert guardadas.fusionar(otra, ruta, ["k", "t"], orden=F.length("v")) == 2
    espera = {(k, t): v for k, t, v in base} | {(3, "a"): "nuevo", (None, None): None, (99, "b"): "z"}
    assert {(r.k, r.t): r.v for r in guardadas.leer(spark, ruta).collect()} == espera
    v = guardadas.version(spark, ruta)
    viejas = [c for c, carpeta in v["cubetas"].items() if carpeta.startswith("0000000001")]
    assert antes <= _archivos(ruta) and len(viejas) >= 5
    guardadas.limpiar(spark, ruta)
    assert len(_archivos(ruta) & antes) >= 5 and guardadas.leer(spark, ruta).count() == len(espera)
    assert guardadas.fusionar(otra.withColumn("v", F.lit("no")), ruta, ["k", "t"], solo_crear=True) == 2
    with pytest.raises(ValueError):
        guardadas.fusionar(otra.drop("v"), ruta, ["k", "t"])


def test_carga_que_falla(spark, tmp_path):
    """A load that fails half way, or meets another one's version, leaves the table as it was."""
    ruta = str(tmp_path / "tabla")
    df = spark.createDataFrame([(k, "a", "v") for k in range(9)], ESQUEMA)
    assert guardadas.fusionar(df.limit(0), ruta, ["k"]) == 1 and guardadas.leer(spark, ruta).isEmpty()
    guardadas.fusionar(df, ruta, ["k"])
    roto = df.withColumn("v", F.when(F.col("k") == 4, F.raise_error(F.lit("roto"))).otherwise("w"))
    with pytest.raises(Exception):
        guardadas.fusionar(roto, ruta, ["k"])
    with pytest.raises(RuntimeError):
        guardadas._publicar(spark, ruta, guardadas.version(spark, ruta))
    assert filas(guardadas.leer(spark, ruta)) == filas(df) and guardadas.version(spark, ruta)["numero"] == 2


def test_grafo_dos_veces(spark, tmp_path):
    n = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    e = spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long")
    for _ in range(2):
        guardadas.fusionar_grafo({"N": n}, {"E": e}, str(tmp_path))
    assert filas(guardadas.leer(spark, f"{tmp_path}/nodos/N")) == filas(n)
    assert guardadas.version(spark, f"{tmp_path}/aristas/E")["numero"] == 1
