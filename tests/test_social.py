import itertools
import random
from collections import Counter

import pytest

from comanda.operators import copurchase, rank, social
from tests.conftest import filas

ARISTAS = [(1, 2, "a"), (2, 1, "a"), (2, 3, "b"), (3, 4, "a"), (4, 5, "c"), (1, 2, "b"), (6, 6, "a"), (7, 1, "a"), (2, 3, "b")]


@pytest.fixture(scope="module")
def usuarios(spark):
    return spark.createDataFrame([(i, f"u{i}", "Cliente") for i in range(1, 12)], "id long, email string, rol string")


@pytest.fixture(scope="module")
def recomienda(spark):
    return spark.createDataFrame(ARISTAS, "src long, dst long, canal string")


def _cadenas(minimo, maximo):
    todas = []
    for largo in range(minimo, maximo + 1):
        for ids in itertools.permutations(range(len(ARISTAS)), largo):
            c = [ARISTAS[i] for i in ids]
            if all(x[1] == y[0] for x, y in zip(c, c[1:])) and c[0][0] != c[-1][1]:
                todas.append((-largo, [c[0][0]] + [x[1] for x in c], [x[2] for x in c]))
    return sorted(todas)


@pytest.mark.parametrize("minimo,maximo,k", [(1, 3, 10), (1, 3, 1000), (2, 2, 10), (1, 4, 5), (1, 3, 1), (3, 4, 2)])
def test_cadenas(spark, recomienda, minimo, maximo, k):
    c = social.cadenas(recomienda, minimo, maximo, k).collect()
    assert [(-r.chain_length, r.nodos, r.canales) for r in c] == _cadenas(minimo, maximo)[:k]


def test_cadenas_con_email(spark, recomienda, usuarios):
    c = social.cadenas_con_email(social.cadenas(recomienda, 1, 3, 3), usuarios).collect()
    assert [r.cadena_emails for r in c] == [[f"u{i}" for i in n] for _, n, _ in _cadenas(1, 3)[:3]]


def test_cadenas_de_un_centro(spark):
    """A start with a million chains and one step taken by a thousand parallel edges: only the first ways are made."""
    medio = spark.range(1000).selectExpr("0L AS src", "id + 1 AS dst", "'a' AS canal", "DATE '2024-01-01' AS fecha")
    fin = spark.range(1_000_000).selectExpr("id % 1000 + 1 AS src", "div(id, 1000) + 5000 AS dst", "'b' AS canal",
                                            "date_add(DATE '2024-02-01', CAST(id % 28 AS INT)) AS fecha")
    paralelas = spark.range(1000).selectExpr("0L AS src", "1L AS dst", "concat('p', id % 7) AS canal",
                                             "date_add(DATE '2024-03-01', CAST(id % 9 AS INT)) AS fecha")
    c = social.cadenas(medio.unionByName(fin).unionByName(paralelas), 1, 3, 12).collect()
    canales = ["a"] + ["p0"] * 11
    assert [(r.nodos, r.canales[0], r.chain_length) for r in c] == [([0, 1, 5000], x, 2) for x in canales]
    fechas = sorted(str(i % 9 + 1) for i in range(0, 1000, 7))[:11]
    assert [r.fechas[0].day for r in c[1:]] == [int(x) for x in fechas]
    pasos = [medio.select("src", "dst"), fin.select("src", "dst")]
    assert social._primeros_caminos(pasos, spark.createDataFrame([(0,)], "src long"), 5).count() == 5


def test_cadenas_sin_aristas(spark):
    nada = spark.createDataFrame([], "src long, dst long, canal string, fecha date")
    assert social.cadenas(nada).count() == 0
    solo = spark.createDataFrame([(1, 1, "a", None), (2, 3, None, None)], "src long, dst long, canal string, fecha date")
    assert [(r.nodos, r.canales, r.fechas) for r in social.cadenas(solo).collect()] == [([2, 3], [None], [None])]


def test_mutuas(recomienda):
    assert filas(social.mutuas(recomienda)) == [(1, 2, 2), (2, 1, 2)]


def test_rankings(recomienda, usuarios):
    r = social.ranking_recomendaciones(recomienda, usuarios, "src", 2).collect()
    assert [(x.id, x.total, [tuple(c) for c in x.canales]) for x in r] == [(2, 3, [("a", 1), ("b", 2)]), (1, 2, [("a", 1), ("b", 1)])]
    e = social.estadisticas_recomendacion(recomienda).first()
    assert (e.total_recomendaciones, e.usuarios_que_recomiendan, e.usuarios_recomendados) == (9, 6, 6)


def test_influencia_cruzada(spark, recomienda, usuarios):
    inf = spark.createDataFrame([(2, 4), (9, 1)], "entidad long, total long")
    col = ["email", "recomendaciones", "influencias", "tipo_usuario"]
    simple = social.influencia_cruzada(recomienda, inf, usuarios, 2).select(*col).collect()
    assert [tuple(r) for r in simple] == [("u2", 3, 4, "Ambos"), ("u1", 2, 0, "Solo Recomienda")]
    literal = social.influencia_cruzada(recomienda, inf, usuarios, 20, True).select(*col).collect()
    assert tuple(literal[0]) == ("u2", 12, 12, "Ambos")
    assert ("u9", 0, 1, "Solo Influye") in [tuple(r) for r in literal]


@pytest.mark.parametrize("paso_sal", [100_000, 3])
def test_pagerank_de_estrellas(spark, paso_sal):
    """Stars of 1, 5 and 20 leaves and one isolated node, with and without salted sources."""
    pares = [(n * 1000, n * 1000 + i) for n in (1, 5, 20) for i in range(1, n + 1)]
    aristas = spark.createDataFrame(pares + [(b, a) for a, b in pares], "src long, dst long")
    nodos = spark.createDataFrame([(x,) for x in {y for p in pares for y in p} | {7}], "id long")
    r = dict(filas(rank.pagerank(nodos, aristas, paso_sal=paso_sal)))
    assert r[1000] == pytest.approx(0.967054, abs=1e-6)
    assert r[5000] == pytest.approx(2.733659, abs=1e-6)
    assert r[20000] == pytest.approx(9.358424, abs=1e-6)
    assert r[7] == pytest.approx(0.15)


def test_componentes(spark):
    estrella = [(500, i) for i in range(501, 620)]
    linea = [(i, i + 1) for i in range(0, 60)]
    ciclo = [(700 + i, 700 + (i + 1) % 9) for i in range(9)]
    ids = list(range(0, 61)) + list(range(500, 620)) + list(range(700, 709)) + [900]
    c = dict(filas(rank.componentes(spark.createDataFrame([(i,) for i in ids], "id long"),
                                    spark.createDataFrame(estrella + linea + ciclo + [(900, 900)], "src long, dst long"))))
    assert c == {i: 0 if i < 100 else 500 if i < 700 else 700 if i < 900 else 900 for i in ids}


def test_recomendar_productos(spark):
    compras = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "usuario_id long, producto_id long")
    d = spark.createDataFrame([(o, p, 1, 1.0) for o, ps in {1: [10, 11], 2: [10, 11], 3: [10, 12], 4: [10, 12], 5: [10, 13]}.items()
                               for p in ps], "src long, dst long, cantidad int, subtotal double")
    assert filas(social.recomendar_productos(compras, d, 2, 5)) == [(1, 1, 12, 2), (2, 1, 11, 2), (2, 2, 12, 2)]


def test_recomendar_con_producto_lleno(spark):
    """A product in a third of the baskets: its buyers are many join keys, of which none holds more than its share."""
    cestas = {u: {u % 7 + 1, u % 11 + 20} | ({99} if u % 3 == 0 else set()) for u in range(240)}
    d = spark.createDataFrame([(u, p, 1, 1.0) for u, ps in cestas.items() for p in ps],
                              "src long, dst long, cantidad int, subtotal double")
    compras = spark.createDataFrame([(u, p) for u, ps in cestas.items() for p in ps], "usuario_id long, producto_id long")
    veces = {}
    for ps in cestas.values():
        for x in itertools.permutations(ps, 2):
            veces[x] = veces.get(x, 0) + 1
    espera = []
    for u, ps in cestas.items():
        puntos = {}
        for (a, b), n in veces.items():
            if a in ps and b not in ps and n >= 2:
                puntos[b] = puntos.get(b, 0) + n
        mejores = sorted(puntos.items(), key=lambda x: (-x[1], x[0]))[:5]
        espera += [(u, i + 1, p, n) for i, (p, n) in enumerate(mejores)]
    for por_clave in (7, 100_000):
        assert filas(social.recomendar_productos(compras, d, 2, 5, por_clave)) == sorted(espera)


def test_recomendar_lee_solo_cabezas(spark):
    """Counts that fall steeply: the threshold leaves most of the lists unread, and the k best are those of all lists."""
    r = random.Random(11)
    pesos = [2.0 ** -(i / 6) for i in range(120)]
    cestas = [set(r.choices(range(120), pesos, k=5)) for _ in range(3000)]
    suyas = {u: set(r.choices(range(120), pesos, k=1 + u % 4)) for u in range(60)}
    d = spark.createDataFrame([(i, p, 1, 1.0) for i, ps in enumerate(cestas) for p in ps],
                              "src long, dst long, cantidad int, subtotal double")
    compras = spark.createDataFrame([(u, p) for u, ps in suyas.items() for p in ps], "usuario_id long, producto_id long")
    veces = Counter(x for ps in cestas for x in itertools.permutations(ps, 2))
    espera = []
    for u, ps in suyas.items():
        puntos = Counter()
        for (a, b), n in veces.items():
            if a in ps and b not in ps and n >= 2:
                puntos[b] += n
        espera += [(u, i + 1, p, n) for i, (p, n) in enumerate(sorted(puntos.items(), key=lambda x: (-x[1], x[0]))[:3])]
    assert filas(social.recomendar_productos(compras, d, 2, 3)) == sorted(espera)
    v = social._Vecinos(compras, d, 2, 100)
    planes = social._plan(v, lambda p: p.join(compras.withColumnRenamed("producto_id", "sugerido"),
                                              ["usuario_id", "sugerido"], "left_anti"), 3)
    leidas = planes.selectExpr("aggregate(leidos, 0L, (s, x) -> s + x.n) AS n").agg({"n": "sum"}).first()[0]
    todas = v.compras.selectExpr("aggregate(bloques, 0L, (s, x) -> s + x.n) AS n").agg({"n": "sum"}).first()[0]
    assert leidas * 2 < todas


def test_recomendar_con_tareas_por_filas(spark, monkeypatch):
    vistos, pares_en_grupo = [], copurchase.pares_en_grupo
    monkeypatch.setattr(copurchase, "pares_en_grupo", lambda *a: (vistos.append(a[5]), pares_en_grupo(*a))[1])
    compras = spark.createDataFrame([(1, 10), (2, 11)], "usuario_id long, producto_id long")
    d = spark.createDataFrame([(o, p, 1, 1.0) for o in range(3) for p in (10, 11, 11)], "src long, dst long, cantidad int, subtotal double")
    assert filas(social.recomendar_productos(compras, d, 2, 5)) == [(1, 1, 11, 6), (2, 1, 10, 6)]
    assert vistos == [6]
