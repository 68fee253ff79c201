import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from comanda.operators import copurchase, similarity
from comanda.plans.durable import Corte
from comanda.plans import pares
from comanda.plans.pares import pares_en_grupo
from tests.conftest import filas


@pytest.mark.parametrize("bloque", [3, 50, None])
def test_bloques_dan_los_mismos_pares(spark, bloque):
    grupos = {1: range(40), 2: [5], 3: [1, 2], 4: range(10, 17)}
    df = spark.createDataFrame([(g, m, m * 10) for g, ms in grupos.items() for m in ms], "g int, m int, v int")
    p = pares_en_grupo(df, ["g"], "m", ["v"], bloque)
    esperado = sorted((g, a, b, a * 10, b * 10) for g, ms in grupos.items() for a, b in itertools.combinations(ms, 2))
    assert filas(p, "g", "menor", "mayor", "v_menor", "v_mayor") == esperado


def _detalle(spark, lineas):
    return spark.createDataFrame([(o, p, c, float(s)) for o, p, c, s in lineas],
                                 "src long, dst long, cantidad int, subtotal double")


def _fuerza_bruta(lineas):
    por = defaultdict(list)
    for o, p, c, s in lineas:
        por[o].append((p, c, s))
    veces, unidades, importe = Counter(), Counter(), Counter()
    for ls in por.values():
        for (p, c, s), (q, d, t) in itertools.permutations(ls, 2):
            if p < q:
                veces[p, q] += 1
                unidades[p, q] += c + d
                importe[p, q] += s + t
    return veces, unidades, importe


@pytest.fixture(scope="module")
def lineas():
    r = random.Random(5)
    ls = [(o, int(30 * r.random() ** 2), r.randint(1, 3), r.randint(1, 50)) for o in range(150) for _ in range(r.randint(1, 5))]
    # one order holds a third of all lines
    ls += [(999, p, 1, 2) for p in range(len(ls) // 2)]
    return ls


def test_mejores_pares(spark, lineas, monkeypatch):
    monkeypatch.setattr(copurchase, "SEMILLAS", 8)
    prod = spark.createDataFrame([(i, f"t{i}", f"c{i % 4}", i % 3) for i in range(400)],
                                 "id long, titulo string, categoria string, restaurante_id long")
    veces, unidades, importe = _fuerza_bruta(lineas)
    d = _detalle(spark, lineas)
    orden = sorted(veces, key=lambda k: (-veces[k], k))[:5]
    assert [(r.id1, r.id2, r.veces, r.cantidad_promedio) for r in copurchase.co_compras(d, prod, 5).collect()] == [
        (*k, veces[k], unidades[k] / veces[k]) for k in orden]
    orden = sorted(veces, key=lambda k: (-veces[k], -importe[k] / veces[k], k))[:10]
    assert [(r.id1, r.id2, r.frecuencia, r.valor_promedio) for r in copurchase.co_compras_valor(d, prod).collect()] == [
        (*k, veces[k], importe[k] / veces[k]) for k in orden]
    mismo = sorted((k for k in veces if k[0] % 3 == k[1] % 3), key=lambda k: (-veces[k], k))[:5]
    assert [(r.id1, r.id2, r.co_compras) for r in copurchase.co_compras_mismo_restaurante(d, prod).collect()] == [
        (*k, veces[k]) for k in mismo]
    cat = Counter()
    for (p, q), n in veces.items():
        if p % 4 != q % 4:
            cat[f"c{p % 4}", f"c{q % 4}"] += n
            cat[f"c{q % 4}", f"c{p % 4}"] += n
    esperado = sorted(((n, k) for k, n in cat.items() if n >= 5), key=lambda x: (-x[0], x[1]))[:5]
    assert [((r.cat1, r.cat2), r.combinaciones) for r in copurchase.co_compras_categoria(d, prod).collect()] == [
        (k, n) for n, k in esperado]


def test_la_poda_descarta_productos(spark, lineas, monkeypatch):
    monkeypatch.setattr(copurchase, "SEMILLAS", 8)
    cesta = copurchase.cestas(_detalle(spark, lineas))
    quedan = {r.dst for r in copurchase._solo_posibles(cesta, 5, ["src"]).select("dst").collect()}
    # the products that only the largest order has are paired with nothing
    assert quedan <= set(range(30)) and max(r.dst for r in cesta.select("dst").collect()) > 100


@pytest.mark.parametrize("umbral", [0.15, 0.5, 0.8])
def test_similitud(spark, umbral):
    r = random.Random(7)
    conj = {e: {int(60 * r.random() ** 2) for _ in range(r.randint(1, 14))} for e in range(90)}
    conj.update({100 + i: {0, 1, 2} for i in range(40)})      # a third are copies of one set
    conj.update({200 + i: conj[i] | {61} for i in range(10)})
    for s in conj.values():
        s.add(0) if r.random() < 0.5 else None                # one item half of them share
    df = spark.createDataFrame([(e, i) for e, s in conj.items() for i in s], "entidad long, item long")
    s = similarity.similitud(df, umbral)
    perfil = dict(filas(s.miembros, "entidad", "perfil"))
    assert all(conj[e] == conj[p] for e, p in perfil.items()) and set(perfil) == set(conj)
    esperado = {}
    for a, b in itertools.combinations(sorted(set(perfil.values())), 2):
        n = len(conj[a] & conj[b])
        if n and n / len(conj[a] | conj[b]) >= umbral:
            esperado[a, b] = (n, n / len(conj[a] | conj[b]))
    assert {(a, b): (n, x) for a, b, n, x in filas(s.aristas, "a", "b", "comunes", "score")} == esperado
    # per entity, copies count as other entities
    total = Counter()
    for a, b in itertools.permutations(conj, 2):
        if len(conj[a] & conj[b]) / len(conj[a] | conj[b]) >= umbral:
            total[a] += 1
    assert dict(filas(similarity.resumen_por_entidad(s), "entidad", "total")) == dict(total)


def _compras(spark, sf):
    o = spark.read.parquet(f"/root/testdata/{sf}/orders.parquet").selectExpr("o_orderkey AS k", "o_custkey AS perfil")
    l = spark.read.parquet(f"/root/testdata/{sf}/lineitem.parquet").selectExpr("l_orderkey AS k", "l_partkey AS item")
    return o.join(l, "k").select("perfil", "item").distinct()


def test_candidatos_cerca_del_resultado(spark):
    """Counting with places leaves few pairs to verify, even where the prefix is nearly the whole set."""
    s = _compras(spark, "sf0.01")
    s = s.join(s.groupBy("perfil").agg(F.count("*").alias("n")), "perfil")
    corte = Corte(spark, "prueba")
    cuantos = similarity.candidatos(s, 0.05, corte)[0].count()
    assert 0 < cuantos <= 5 * similarity._pares(s, 0.05, corte).count()


@pytest.mark.parametrize("rangos", [1, 7])
def test_lugares(spark, rangos):
    """Places in a set, also of one that holds a third of all rows and lies in several ranges."""
    conj = {1: range(600), 2: range(0, 900, 3), 3: [5], 4: range(300, 1100)}
    veces = Counter(i for c in conj.values() for i in c)
    datos = [(p, i, len(c) + 10 * p, veces[i]) for p, c in conj.items() for i in c]
    df = spark.createDataFrame(datos, "perfil long, item long, n long, f long").repartition(rangos)
    spark.conf.set("spark.sql.shuffle.partitions", str(rangos))
    try:
        r = filas(similarity._con_lugar(df, Corte(spark, "prueba")), "perfil", "item", "lugar")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    esperado = []
    for p, c in conj.items():
        esperado += [(p, i, k + 10 * p) for k, i in enumerate(sorted(c, key=lambda i: (veces[i], i)))]
    assert r == sorted(esperado)


def test_resumen_de_aristas(spark):
    e = spark.createDataFrame([(1, 2, 0.5, 3), (1, 3, 0.25, 1), (2, 1, 0.5, 3)],
                              "src long, dst long, score double, productos_comunes long")
    assert [(r.entidad, r.total, float(r.suma_score), r.productos_comunes)
            for r in similarity.resumen_de_aristas(e).orderBy("entidad").collect()] == [(1, 2, 0.75, 4), (2, 1, 0.5, 3)]


def test_pares_con_tareas_por_filas(spark, monkeypatch):
    """A join of known size has tasks by rows, however few bytes they shuffle; the pairs stay the same."""
    df = spark.range(6000).selectExpr("id % 700 AS g", "id AS m", "id % 3 AS v")
    espera = filas(pares.pares_en_grupo(df, ["g"], "m", ["v"], bloque=4))
    monkeypatch.setattr(pares, "FILAS_POR_TAREA", 250)
    p = pares.pares_en_grupo(df, ["g"], "m", ["v"], bloque=4, filas=6000)
    assert p.rdd.getNumPartitions() == 24 and filas(p) == espera


def test_categorias_con_tareas_por_filas(spark, monkeypatch):
    vistos = []
    pares_en_grupo = copurchase.pares_en_grupo
    monkeypatch.setattr(copurchase, "pares_en_grupo",
                        lambda *a, **k: (vistos.append(k.get("filas")), pares_en_grupo(*a, **k))[1])
    detalle = spark.range(40).selectExpr("id % 10 AS src", "id % 8 AS dst")
    productos = spark.range(8).selectExpr("id", "concat('c', id % 3) AS categoria")
    copurchase.co_compras_categoria(detalle, productos, 10, 1).collect()
    assert vistos == [detalle.join(productos.withColumnRenamed("id", "dst"), "dst").select("src", "categoria").distinct().count()]


@pytest.mark.parametrize("bloque", [3, 512])
def test_listas_en_grupo(spark, bloque):
    grupos = {1: range(40), 2: [5], 3: [1, 2], 4: range(10, 17)}
    df = spark.createDataFrame([(g, m, m % 3, len(ms)) for g, ms in grupos.items() for m in ms], "g int, m int, v int, c int")
    va = lambda p, q: (p["m"] < q["m"]) & (p["v"] == q["v"])
    l = pares.listas_en_grupo(df, ["g"], ["m", "v"], "m", va, "c", 50, bloque)
    esperado = sorted((a, b) for ms in grupos.values() for a, b in itertools.combinations(ms, 2) if a % 3 == b % 3)
    assert filas(l.select("m", F.explode("ms").alias("o"))) == esperado
    assert l.select(F.max(F.size("ms"))).first()[0] <= (13 if bloque == 512 else 10)


@pytest.mark.parametrize("bloque", [4, 512])
def test_similitud_sin_filas_de_pares(spark, bloque, monkeypatch):
    # 60 sets of 30 items that all share 20: 1,770 pairs, 35,400 and more pairings
    conj = {e: set(range(20)) | {100 + (7 * e + i) % 90 for i in range(10)} for e in range(60)}
    df = spark.createDataFrame([(e, i) for e, s in conj.items() for i in s], "entidad long, item long")
    listas, vistas = similarity.listas_en_grupo, []

    def contar(*args):
        vistas.append(listas(*args, bloque=bloque))
        return vistas[-1]

    monkeypatch.setattr(similarity, "listas_en_grupo", contar)
    monkeypatch.setattr(similarity, "PAREJAS_POR_TAREA", 5_000)
    monkeypatch.setattr(pares, "MIEMBROS_POR_TAREA", 500)
    s = similarity.similitud(df, 0.3)
    esperado = {(a, b): len(conj[a] & conj[b]) for a, b in itertools.combinations(conj, 2)
                if len(conj[a] & conj[b]) / len(conj[a] | conj[b]) >= 0.3}
    assert {(a, b): n for a, b, n in filas(s.aristas, "a", "b", "comunes")} == esperado
    # what is shuffled: lists of a set and an item, not pairings
    assert vistas[0].agg(F.sum(F.size("perfils"))).first()[0] > 20_000
    if bloque == 512:
        assert vistas[0].count() < 60 * 30
