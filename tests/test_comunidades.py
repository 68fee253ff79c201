import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from comanda.operators import comunidades as com
from comanda.operators.rank import componentes
from tests.conftest import filas


def _q(aristas, grupo):
    """Modularity by its definition over all edges."""
    m = sum(w for a, b, w in aristas if a != b)
    dentro = sum(w for a, b, w in aristas if a != b and grupo[a] == grupo[b])
    tot = {}
    for a, b, w in aristas:
        if a != b:
            for x in (a, b):
                tot[grupo[x]] = tot.get(grupo[x], 0) + w
    return dentro / m - sum((t / (2 * m)) ** 2 for t in tot.values())


def _particiones(ids):
    if not ids:
        yield []
        return
    for p in _particiones(ids[1:]):
        yield [[ids[0]], *p]
        for i in range(len(p)):
            yield [*p[:i], [ids[0], *p[i]], *p[i + 1:]]


def _hallar(spark, nodos, aristas):
    n = spark.createDataFrame([(i,) for i in nodos], "id long")
    e = spark.createDataFrame(aristas, "src long, dst long, peso long")
    return dict(filas(com.comunidades(n, e)))


def _plantada(grupos, tam, dentro, fuera, semilla):
    r = random.Random(semilla)
    de = {i: i // tam for i in range(grupos * tam)}
    return de, [(a, b, 1) for a, b in itertools.combinations(de, 2) if r.random() < (dentro if de[a] == de[b] else fuera)]


def test_anillo_de_grupos(spark):
    """Groups of five, all tied within, in a ring with one edge between neighbours: one component, eight communities."""
    aristas = [(5 * g + a, 5 * g + b, 1) for g in range(8) for a, b in itertools.combinations(range(5), 2)]
    aristas += [(5 * g, (5 * g + 6) % 40, 1) for g in range(8)]
    assert _hallar(spark, range(42), aristas) == {i: 5 * (i // 5) for i in range(40)} | {40: 40, 41: 41}


def test_particion_plantada(spark):
    de, aristas = _plantada(6, 30, 0.5, 0.01, 3)
    hallado = _hallar(spark, de, aristas)
    assert hallado == {i: 30 * g for i, g in de.items()}
    n = spark.createDataFrame([(i,) for i in de], "id long")
    assert componentes(n, spark.createDataFrame(aristas, "src long, dst long, peso long")).select("comunidad").distinct().count() == 1


@pytest.mark.parametrize("semilla", [1, 2])
def test_cerca_del_mejor(spark, semilla):
    """Against all partitions of eight nodes."""
    r = random.Random(semilla)
    aristas = [(a, b, r.randint(1, 4)) for a, b in itertools.combinations(range(8), 2) if r.random() < 0.4]
    mejor = max(_q(aristas, {x: i for i, p in enumerate(ps) for x in p}) for ps in _particiones(list(range(8))))
    assert _q(aristas, _hallar(spark, range(8), aristas)) >= 0.9 * mejor


def test_centro_lleno(spark):
    """A node tied to every other, with far more than a thousandth of all edges, goes by broadcast; the groups stay."""
    de, aristas = _plantada(5, 20, 0.7, 0.0, 5)
    hallado = _hallar(spark, range(101), aristas + [(100, i, 1) for i in range(100)])
    assert len({hallado[i] for i in range(100)}) == 5 and all(hallado[i] == 20 * (i // 20) for i in range(100))


def test_casos(spark):
    """Loops, null ends and weights, weights of nothing, parallel and opposite edges, repeated nodes, unknown ends."""
    aristas = [(1, 1, 9), (None, 2, 1), (2, None, 1), (3, 4, None), (5, 6, 0), (7, 8, 1), (8, 7, 1), (7, 8, 1), (9, 77, 1)]
    n = spark.createDataFrame([(i,) for i in [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]], "id long")
    e = spark.createDataFrame(aristas, "src long, dst long, peso long")
    assert filas(com.comunidades(n, e)) == [(i, i) for i in range(1, 8)] + [(8, 7), (9, 9), (9, 9)]
    assert filas(com.comunidades(n, e.limit(0))) == sorted((i, i) for i in [1, 2, 3, 4, 5, 6, 7, 8, 9, 9])
    assert com.comunidades(n.limit(0), e).count() == 0


def test_calidad(spark):
    de, aristas = _plantada(4, 10, 0.6, 0.05, 7)
    grupo = {i: 10 * g for i, g in de.items()}
    c = com.calidad(spark.createDataFrame(list(grupo.items()) + [(99, 99)], "id long, comunidad long"),
                    spark.createDataFrame(aristas, "src long, dst long, peso long")).collect()
    assert sum(r.modularidad for r in c) == pytest.approx(_q(aristas, grupo))
    assert sum(r.miembros for r in c) == 41
    assert {r.comunidad: (r.peso_dentro, r.peso_fuera) for r in c} == {99: (0, 0)} | {
        10 * g: (sum(de[a] == de[b] == g for a, b, _ in aristas), sum((de[a] == g) != (de[b] == g) for a, b, _ in aristas))
        for g in range(4)}


def _al_azar(spark):
    r = random.Random(11)
    aristas = [(r.randint(-40, 79), r.randint(0, 79) ** 2, r.randint(1, 3)) for _ in range(260)] + [(500, i, 1) for i in range(60)]
    n = spark.createDataFrame([(i,) for i in sorted({x for e in aristas for x in e[:2]})], "id long")
    return n, spark.createDataFrame(aristas, "src long, dst long, peso long")


@pytest.mark.parametrize("filas_en_tarea", [0, 400])
def test_en_una_tarea_como_en_rondas(spark, monkeypatch, filas_en_tarea):
    """Rounds of jobs, at no size or at the first level only, give what one task gives."""
    n, e = _al_azar(spark)
    en_tarea = filas(com.comunidades(n, e))
    monkeypatch.setattr(com, "FILAS_EN_TAREA", filas_en_tarea)
    assert filas(com.comunidades(n, e)) == en_tarea
    assert 1 < len({c for _, c in en_tarea}) < len(en_tarea)


def test_red_pequena_en_pocos_trabajos(spark):
    """A round of a network that fits one task starts no job: hundreds of them before."""
    n, e = _al_azar(spark)
    spark.sparkContext.setJobGroup("comunidades", "comunidades")
    try:
        com.comunidades(n, e).count()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("comunidades")) < 100


def test_sorteo_de_spark(spark):
    """Whose turn it is in a round, in a task as by Spark's function."""
    ids = [0, 1, -1, 2**40 + 7, -2**62, 12345, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    for ronda in (0, 1, 77):
        h = [r[0] for r in df.select(F.xxhash64("id", F.lit(ronda))).collect()]
        assert com._xxhash64(np.array(ids), ronda).view(np.int64).tolist() == h
