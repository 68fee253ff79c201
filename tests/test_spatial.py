import math
import random

import pytest
from pyspark.sql import functions as F

from comanda.operators import spatial
from comanda.plans.durable import Corte
from tests.conftest import filas


def _cerca(p, nodos, metrica):
    f = (lambda a, b: abs(a) + abs(b)) if metrica == "manhattan" else (lambda a, b: math.sqrt(a * a + b * b))
    return min((f(p[1] - n[1], p[2] - n[2]), n[0]) for n in nodos)


@pytest.fixture(scope="module")
def datos():
    r = random.Random(3)
    nodos = [(i, 9.8 + r.random() * 0.02, -83.9 + r.random() * 0.02) for i in range(150)]
    nodos += [(1000 + i, 9.81, -83.89) for i in range(80)]                       # a third at one place
    nodos += [(2000, 9.9, -83.7), (2001, 10.4, -83.0), (2002, -33.0, 151.0)]
    puntos = [(i, 9.79 + r.random() * 0.05, -83.92 + r.random() * 0.06) for i in range(120)]
    puntos += [(500, 9.802, -83.9), (501, 9.81, -83.89), (502, 9.81, -83.89), (503, 0.0, 0.0), (504, 10.0, -83.5)]
    return puntos, nodos


@pytest.mark.parametrize("metrica", ["plana", "manhattan"])
def test_mas_cercano_sin_radio(spark, datos, metrica):
    puntos, nodos = datos
    p, n = (spark.createDataFrame(x, "id long, lat double, lon double") for x in datos)
    r = {i: (g, c) for i, g, c in filas(spatial.mas_cercano(p, n, metrica), "id", "grados", "calle_id")}
    assert r == {x[0]: _cerca(x, nodos, metrica) for x in puntos}


def test_celda_llena_y_sin_lugar(spark, monkeypatch):
    """A third of the points in one cell, cut into many parts, and a third without coordinates."""
    monkeypatch.setattr(spatial, "PUNTOS_POR_CELDA", 7)
    r = random.Random(5)
    nodos = [(i, 9.8 + r.random() * 0.01, -83.9 + r.random() * 0.01) for i in range(60)]
    puntos = [(i, 9.8021 + r.random() * 0.0015, -83.8979 + r.random() * 0.0015) for i in range(90)]
    puntos += [(100 + i, 9.8 + r.random() * 0.01, -83.9 + r.random() * 0.01) for i in range(90)]
    nulos = [(300 + i, *((None, -83.9), (9.8, None), (None, None))[i % 3]) for i in range(90)]
    p = spark.createDataFrame(puntos + nulos, "id long, lat double, lon double")
    n = spark.createDataFrame(nodos, "id long, lat double, lon double")
    hallados = {i: (g, c) for i, g, c in filas(spatial.mas_cercano(p, n).fillna(-1, ["grados", "calle_id"]), "id", "grados", "calle_id")}
    assert hallados == {x[0]: _cerca(x, nodos, "plana") for x in puntos} | {x[0]: (-1, -1) for x in nulos}


def test_lugar_lleno(spark):
    """Half of the points at one place stay dealt out as they were read."""
    azar = random.Random(8)
    puntos = [(i, *((9.81, -83.89) if i % 2 else (9.8 + azar.random() * 0.02, -83.9 + azar.random() * 0.02)))
              for i in range(2000)]
    nodos = [(i, 9.8 + azar.random() * 0.02, -83.9 + azar.random() * 0.02) for i in range(40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = spatial.mas_cercano(spark.createDataFrame(puntos, "id long, lat double, lon double").repartition(8),
                                spark.createDataFrame(nodos, "id long, lat double, lon double"))
        assert dict(filas(r, "id", "calle_id")) == {x[0]: _cerca(x, nodos, "plana")[1] for x in puntos}
        partes = r.groupBy(F.spark_partition_id().alias("parte")).count().collect()
        assert len(partes) >= 8 and max(x["count"] for x in partes) <= 2000 // 5
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_radio_estricto(spark, datos):
    puntos, nodos = datos
    p, n = (spark.createDataFrame(x, "id long, lat double, lon double") for x in datos)
    d0 = _cerca(puntos[0], nodos, "plana")[0] * 111_000.0
    for radio in (d0, 700.0, 5000.0):                                            # d0: exactly on the border
        r = dict(filas(spatial.calle_mas_cercana(p, n, radio), "id", "calle_id"))
        e = {x[0]: _cerca(x, nodos, "plana") for x in puntos}
        assert r == {i: (c if g * 111_000.0 < radio else None) for i, (g, c) in e.items()}


def test_registro(spark):
    n = spark.createDataFrame([(1, 9.8, -83.9), (2, 9.8, -83.9)], "id long, lat double, lon double")
    c = spark.createDataFrame([(1, 9.8, -83.9), (2, 9.9, -83.9)], "id long, lat double, lon double")
    dentro, fuera = spatial.registrar_clientes(c, n)
    assert filas(dentro, "id", "calle_id", "distancia") == [(1, 1, 0.0)] and filas(fuera, "id") == [(2,)]
    assert filas(spatial.registrar_repartidores(c, n), "id", "calle_actual") == [(1, 1), (2, None)]
    vacio = n.filter("id < 0")
    assert filas(spatial.registrar_repartidores(c, vacio), "id", "calle_actual") == [(1, None), (2, None)]


def test_ultima_posicion(spark):
    r = spark.createDataFrame([(1, 0.0, 0.0, True), (2, 5.0, 6.0, True)], "id long, lat double, lon double, activo boolean")
    p = spark.sql("SELECT 1L AS repartidor_id, 1D AS lat, 2D AS lon, timestamp'2024-01-02' AS ts, 1 AS secuencia "
                  "UNION ALL SELECT 1, 3D, 4D, timestamp'2024-01-02', 2 UNION ALL SELECT 1, 9D, 9D, timestamp'2024-01-01', 9")
    assert filas(spatial.ultima_posicion(r, p)) == [(1, 3.0, 4.0, True), (2, 5.0, 6.0, True)]


def test_tablas_que_crecen_no_se_difunden(spark, monkeypatch):
    # small files tempt Spark to broadcast every side; places, cells and answers grow with the input
    planes = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    guardar = Corte.guardar
    monkeypatch.setattr(Corte, "guardar", lambda self, df: (planes.append(plan(df)), guardar(self, df))[1])
    puntos = spark.range(50).selectExpr("id", "9.8 + id / 1000 AS lat", "-84.0 AS lon")
    nodos = spark.range(50).selectExpr("id", "9.8 + id / 1100 AS lat", "-84.0 AS lon")
    c = spatial.calle_mas_cercana(puntos, nodos)
    planes.append(plan(c))
    con_union = [p for p in planes if "Join" in p]
    assert len(con_union) >= 4 and all("SortMergeJoin" in p for p in con_union)
    assert plan(c).count("SortMergeJoin") == 2
    assert c.filter("calle_id IS NULL").count() == 0
