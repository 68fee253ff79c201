import heapq
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from comanda.operators import paths
from tests.conftest import filas

MINI = [(1, 2, 10.0), (2, 3, 10.0), (1, 4, 10.0), (4, 3, 10.0), (1, 5, 1.0), (5, 6, 1.0), (6, 7, 1.0), (7, 3, 1.0), (8, 9, 4.0)]


def _dijkstra(aristas, origen, por):
    ady = defaultdict(dict)
    for a, b, w in aristas:
        if a != b:
            ady[a][b] = min(w, ady[a].get(b, w))
            ady[b][a] = min(w, ady[b].get(a, w))
    mejor, cola = {}, [((0, 0.0), origen)]
    while cola:
        c, v = heapq.heappop(cola)
        if v in mejor:
            continue
        mejor[v] = c
        for u, w in ady[v].items():
            if u not in mejor:
                heapq.heappush(cola, ((c[0] + 1, c[1] + w) if por == "saltos" else (c[0] + w, c[1] + 1), u))
    return mejor


def _df(spark, aristas):
    return spark.createDataFrame(aristas, "src long, dst long, distancia double")


@pytest.fixture(scope="module")
def azar():
    r = random.Random(11)
    e = [(r.randrange(60), r.randrange(60), float(r.randint(1, 20))) for _ in range(90)]
    return e + [(99, i, float(1 + i % 7)) for i in range(0, 60, 2)]              # a hub with a third of the edges


@pytest.mark.parametrize("por,paso_sal", [("saltos", 100_000), ("saltos", 4), ("distancia", 4)])
def test_etiquetas(spark, azar, por, paso_sal):
    o = spark.createDataFrame([(i,) for i in (0, 7, 99, 1234)], "origen long")
    et = paths.etiquetas(o, _df(spark, azar), por, pasos=3, paso_sal=paso_sal)
    r = {(a, b): (s, d) if por == "saltos" else (d, s) for a, b, s, d in filas(et, "origen", "nodo", "saltos", "distancia")}
    e = {(i, v): c for i in (0, 7, 99, 1234) for v, c in _dijkstra(azar, i, por).items()}
    assert r == e


def _con_cadenas(aristas, largo):
    """Every segment becomes a chain of up to ``largo`` segments, and a ring hangs in the air."""
    salida, nuevo = [], 10_000
    for k, (a, b, w) in enumerate(aristas):
        n = 1 + k * 7 % largo
        nodos = [a, *range(nuevo, nuevo + n - 1), b]
        nuevo += n
        salida += [(x, y, w + j) for j, (x, y) in enumerate(zip(nodos, nodos[1:]))]
    return salida + [(90_000, 90_001, 1.0), (90_001, 90_002, 1.0), (90_002, 90_000, 1.0)]


@pytest.mark.parametrize("tope", [3, 25])
def test_ruta_por_tramos(spark, azar, tope):
    e = _con_cadenas(azar, 9) + [(0, 3, 5.0), (7, 7, 1.0)]
    # ends at junctions, inside chains, in the same chain, on the ring, nowhere
    pares = [(a, b) for a in (0, 7, 99, 10_012, 90_000, 77_777) for b in (0, 3, 12, 57, 10_012, 10_014, 10_100, 90_001, 77_777)]
    df = spark.createDataFrame(pares, "origen long, destino long")
    columnas = ("origen", "destino", "num_calles", "distancia", "calles")
    esperada = filas(paths.ruta_mas_corta(df, _df(spark, e), tope), *columnas)
    assert filas(paths.ruta_por_tramos(df, _df(spark, e), tope), *columnas) == esperada
    corto = {(a, b): _dijkstra(e, a, "saltos").get(b, (0, 0.0) if a == b else None) for a, b in pares}
    assert {x[:2]: (x[2], x[3]) for x in esperada} == {k: v for k, v in corto.items() if v and v[0] <= tope}


def test_red_contraida(spark):
    """A road of 300 segments between two junctions is one row each way; its rounds are few, with and without a limit."""
    e = [(i, i + 1, 1.0) for i in range(300)] + [(0, -1, 1.0), (0, -2, 1.0), (300, 301, 1.0), (300, 302, 1.0)]
    df, paradas = _df(spark, e), spark.createDataFrame([], "id long")
    c = paths.contraer(df, paradas)
    assert (0, 1, 300, 299, 300, 300.0) in filas(c.tramos) and c.tramos.count() == 10
    assert filas(c.dentro.filter("src = 0"), "pos", "nodo") == [(i, i) for i in range(1, 300)]
    assert filas(paths.contraer(df, paradas, 100).tramos.filter("saltos > 1")) == []
    medio = paths.contraer(df, spark.createDataFrame([(150,)], "id long"))
    assert (300, 299, 150, 151, 150, 150.0) in filas(medio.tramos)
    vacia = paths.contraer(df.limit(0), paradas)
    assert vacia.tramos.isEmpty() and vacia.dentro.isEmpty()


@pytest.mark.parametrize("tope", [1, 4, 5])
def test_entre_pares(spark, azar, tope):
    pares = [(a, b) for a in (0, 3, 7, 99) for b in range(0, 60, 3)]
    df = spark.createDataFrame(pares, "origen long, destino long")
    t = paths.entre_pares(df, _df(spark, azar), tope)
    e = {}
    for a, b in pares:
        c = _dijkstra(azar, a, "saltos").get(b, (0, 0.0) if a == b else None)
        if c is not None and c[0] <= tope:
            e[a, b] = c
    assert {(a, b): (s, d) for a, b, s, d in filas(t.pares, "origen", "destino", "saltos", "distancia")} == e
    peso = {}
    for a, b, w in azar:
        for k in ((a, b), (b, a)):
            peso[k] = min(w, peso.get(k, w))
    for r in paths.caminos_de_trayectos(df, t).collect():
        assert (r.calles[0], r.calles[-1], len(r.calles) - 1) == (r.origen, r.destino, e[r.origen, r.destino][0])
        assert sum(peso[x] for x in zip(r.calles, r.calles[1:])) == e[r.origen, r.destino][1]


def test_solo_saltos(spark, azar):
    o = spark.createDataFrame([(i,) for i in (0, 7, 99, 1234)], "origen long")
    for tope, paso_sal in ((None, 4), (3, 100_000)):
        e = sorted((i, v, c[0]) for i in (0, 7, 99, 1234) for v, c in _dijkstra(azar, i, "saltos").items()
                   if tope is None or c[0] <= tope)
        assert filas(paths.saltos_entre(o, _df(spark, azar), tope, pasos=2, paso_sal=paso_sal)) == e


def test_hitos_acotan(spark):
    """On a long strip, the search for near targets writes labels near them only, and finds the same ways."""
    tira = [(i, i + 1, 1.0 + i % 3) for i in range(400)] + [(i, 1000 + i, 2.0) for i in range(0, 400, 5)]
    tira += [(1000 + i, 1005 + i, 5.0 + i % 2) for i in range(0, 395, 5)]
    lejos = [(9000 + i, 9001 + i, 1.0) for i in range(10)]
    red = _df(spark, tira + lejos)
    pares = [(200, 210), (200, 195), (205, 1230), (50, 50), (60, 9003), (9002, 9009), (777777, 3)]
    df = spark.createDataFrame(pares, "origen long, destino long")
    podar = paths.poda_por_hitos(df, paths.hitos(red, 4))
    et = paths.etiquetas(df.select("origen"), red, "distancia", podar=podar)
    cuantas = dict(et.groupBy("origen").count().collect())
    # no bound for the target on the other side, one node for the pair at one place
    assert cuantas[200] < 60 and cuantas[205] < 120 and cuantas[50] < 20
    r = {(x.origen, x.destino): x.distancia for x in paths.ruta_menor_distancia(df, red).collect()}
    assert r == {p: c[0] for p in pares if (c := _dijkstra(tira + lejos, p[0], "distancia").get(p[1])) is not None}


@pytest.mark.parametrize("cuantos", [1, 3, 16])
def test_hitos_al_azar(spark, azar, cuantos):
    pares = [(a, b) for a in (0, 3, 7, 99) for b in range(0, 60, 7)]
    df = spark.createDataFrame(pares, "origen long, destino long")
    red = _df(spark, azar)
    et = paths.etiquetas(df.select("origen"), red, "distancia", pasos=2, podar=paths.poda_por_hitos(df, paths.hitos(red, cuantos)))
    r = {(x.origen, x.destino): (x.distancia, x.saltos, x.calles) for x in paths.caminos(df, et).collect()}
    todas = paths.caminos(df, paths.etiquetas(df.select("origen"), red, "distancia", pasos=2)).collect()
    assert r == {(x.origen, x.destino): (x.distancia, x.saltos, x.calles) for x in todas}


def test_limite_de_saltos(spark, azar):
    o = spark.createDataFrame([(0,), (7,)], "origen long")
    for tope in (1, 2, 3):
        et = paths.etiquetas(o, _df(spark, azar), "saltos", tope, pasos=2)
        e = sorted((i, v) for i in (0, 7) for v, c in _dijkstra(azar, i, "saltos").items() if c[0] <= tope)
        assert filas(et, "origen", "nodo") == e


def test_ruta_por_saltos_y_por_distancia(spark):
    pares = spark.createDataFrame([(1, 3), (1, 9), (2, 2)], "origen long, destino long")
    por_saltos = paths.ruta_mas_corta(pares, _df(spark, MINI))
    # two paths of two segments and 20 m: the smaller predecessor wins; 9 is not reachable
    assert [(r.origen, r.num_calles, r.distancia, r.calles) for r in por_saltos.orderBy("origen").collect()] == [
        (1, 2, 20.0, [1, 2, 3]), (2, 0, 0.0, [2])]
    corta = paths.ruta_menor_distancia(pares, _df(spark, MINI)).orderBy("origen").collect()
    assert [(r.num_calles, r.distancia, r.calles) for r in corta] == [(4, 4.0, [1, 5, 6, 7, 3]), (0, 0.0, [2])]


def test_caminos_son_validos(spark, azar):
    peso = {}
    for a, b, w in azar:
        for k in ((a, b), (b, a)):
            peso[k] = min(w, peso.get(k, w))
    pares = spark.createDataFrame([(a, b) for a in (0, 99) for b in range(60)], "origen long, destino long")
    rutas = paths.ruta_mas_corta(pares, _df(spark, azar)).collect()
    assert len(rutas) > 60
    for r in rutas:
        assert r.calles[0] == r.origen and r.calles[-1] == r.destino and len(r.calles) == r.num_calles + 1
        assert sum(peso[t] for t in zip(r.calles, r.calles[1:])) == r.distancia


def test_detalle_y_resumen(spark):
    nodos = spark.createDataFrame([(i, float(i), -float(i)) for i in range(1, 10)], "id long, lat double, lon double")
    nombres = _df(spark, MINI).withColumn("nombre", F.concat(F.lit("c"), F.col("src")))
    pares = spark.createDataFrame([(1, 3)], "origen long, destino long")
    ruta = paths.ruta_menor_distancia(pares, nombres)
    pasos = paths.pasos_de_ruta(ruta, ["origen"], nodos, nombres, 10).orderBy("paso").collect()
    assert [(p.paso, p.nodo_id, p.calle, p.distancia_m) for p in pasos] == [
        (1, 1, "c1", 1.0), (2, 5, "c5", 1.0), (3, 6, "c6", 1.0), (4, 7, "c7", 1.0), (5, 3, "DESTINO", 0.0)]
    primeros = paths.pasos_de_ruta(ruta, ["origen"], nodos, nombres, 2).orderBy("paso").collect()
    assert [(p.paso, p.calle) for p in primeros] == [(1, "c1"), (2, "c5")]
    d = paths.detalle_de_ruta(ruta, ["origen"], nodos, nombres).first()
    assert (d.total_segmentos, [n.osm_id for n in d.nodos], [c.nombre for c in d.calles]) == (4, [1, 5, 6, 7, 3], ["c1", "c5", "c6", "c7"])
    assert [tuple(c) for c in paths.con_coordenadas(ruta, nodos, ["origen"]).first().coordenadas][0] == (1.0, -1.0)
    s = spark.createDataFrame([(1, 2, 11000.0, 110, [1, 2])], "origen long, destino long, distancia double, num_calles int, calles array<long>")
    m = paths.resumen_de_ruta(s, nodos, ["origen", "destino"]).first()
    assert (m.distancia_km, m.tiempo_estimado_min, m.segmentos, m.lat_destino) == (11.0, 22.0, 110, 2.0)


def test_anclas(spark):
    r = spark.createDataFrame([(1, "r1", 1), (2, "r2", 8), (3, "r3", 1)], "id long, nombre string, osm_node_id long")
    c = spark.createDataFrame([(1, "c1", 3), (2, "c2", 9)], "id long, nombre string, osm_node_id long")
    e = _df(spark, MINI)
    m = paths.matriz_conectividad(r, c, e)
    assert filas(m, "restaurante", "cliente", "segmentos", "estado") == [
        ("r1", "c1", 2, "CONECTADO"), ("r1", "c2", 0, "SIN RUTA"), ("r2", "c1", 0, "SIN RUTA"),
        ("r2", "c2", 1, "CONECTADO"), ("r3", "c1", 2, "CONECTADO"), ("r3", "c2", 0, "SIN RUTA")]
    x = paths.alcances(r, c, e)
    assert filas(paths.prueba_conectividad(x, r, c)) == [(3, 6)]
    assert [f.restaurante for f in paths.rutas_extremas(x, r, c, 1).collect()] == ["r2"]
    assert [f.restaurante for f in paths.rutas_extremas(x, r, c, 2, True).collect()] == ["r1", "r3"]
    assert filas(paths.segmentos_por_restaurante(x, r)) == [("r1", 2.0, 2, 2), ("r2", 1.0, 1, 1), ("r3", 2.0, 2, 2)]
    assert [tuple(f) for f in paths.promedio_segmentos(x, c, "cliente").collect()] == [("c2", 1.0), ("c1", 2.0)]


def test_informes_sin_pares(spark, azar):
    """Many restaurants and customers at few nodes: reports from counts against the pairs themselves."""
    azar_ = random.Random(2)
    e = _df(spark, azar)
    r = [(i, f"r{i % 37}", azar_.choice([0, 0, 7, 99, 1234])) for i in range(60)]
    c = [(i, f"c{i}", azar_.choice([3, 3, 3, 99, 12, 40, 777])) for i in range(90)]
    rd, cd = (spark.createDataFrame(x, "id long, nombre string, osm_node_id long") for x in (r, c))
    saltos = {o: _dijkstra(azar, o, "saltos") for o in {x[2] for x in r}}
    pares = [(saltos[ro][co][0], ri, ci, rn, cn) for ri, rn, ro in r for ci, cn, co in c if co in saltos[ro]]
    x = paths.alcances(rd, cd, e)
    assert x.count() <= 35
    assert filas(paths.prueba_conectividad(x, rd, cd)) == [(len(pares), 60 * 90)]
    for largas in (False, True):
        for k in (1, 5, 200):
            mejores = sorted(pares, key=lambda p: (-p[0] if largas else p[0], p[1], p[2]))[:k]
            assert [tuple(f) for f in paths.rutas_extremas(x, rd, cd, k, largas).collect()] == [
                (rn, cn, s) for s, _, _, rn, cn in mejores]
    por = defaultdict(list)
    for s, ri, ci, rn, cn in pares:
        por["r", ri, rn].append(s)
        por["c", ci, cn].append(s)
    promedio = lambda v: float(round(sum(v) / len(v) + 1e-12, 2))
    assert filas(paths.segmentos_por_restaurante(x, rd)) == sorted(
        (n, promedio(v), min(v), max(v)) for (t, _, n), v in por.items() if t == "r")
    assert filas(paths.promedio_segmentos(x, cd, "cliente")) == sorted(
        (n, promedio(v)) for (t, _, n), v in por.items() if t == "c")


def test_alcance(spark):
    nodos = spark.createDataFrame([(i,) for i in range(0, 10)], "id long")
    assert filas(paths.alcance(nodos, _df(spark, MINI), inicios=2, max_saltos=1)) == [(4, 1)]


def test_pares_de_bloques(spark):
    """All pairs, repeated rows and null names among them, for any number of blocks on either side."""
    for n, m, bloque in ((7, 5, 2), (1, 9, 3), (0, 4, 2), (4, 0, 2), (6, 6, 100)):
        a = [(i // 2, None if i % 3 == 0 else f"r{i // 2}") for i in range(n)]
        b = [(i, f"c{i}") for i in range(m)]
        p = paths.pares_de_bloques(spark.createDataFrame(a, "x long, y string"), spark.createDataFrame(b, "u long, v string"), bloque)
        assert sorted(map(repr, map(tuple, p.collect()))) == sorted(repr((*x, *y)) for x in a for y in b)


def test_matriz_sin_limite(spark):
    """More restaurants than the 10,000 that were once refused."""
    n = 10_050
    r = spark.range(n).selectExpr("id", "concat('r', id) AS nombre", "id % 3 AS osm_node_id")
    c = spark.createDataFrame([(1, "c1", 2), (2, "c2", 50)], "id long, nombre string, osm_node_id long")
    e = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0)], "src long, dst long, distancia double")
    m = paths.matriz_conectividad(r, c, e)
    cuenta = {(x.cliente_id, x.estado): (x["count"], x.s) for x in m.groupBy("cliente_id", "estado").agg(
        F.count("*").alias("count"), F.sum("segmentos").alias("s")).collect()}
    # node 2 is two segments from node 0, one from node 1 and none from itself
    assert cuenta[2, "SIN RUTA"] == (n, 0) and m.select("restaurante_id", "cliente_id").distinct().count() == 2 * n
    assert cuenta[1, "CONECTADO"] == (n, 3 * n // 3)


@pytest.mark.parametrize("bloque", [3, 1000])
def test_matriz_sin_barajar_pares(spark, bloque):
    """Crowded nodes, repeated and missing ids and nodes: the rows of the join of all pairs with the joined ones."""
    r = [(i, f"r{i}", i % 4) for i in range(20)] + [(3, "r3", 3), (None, "sin id", 1), (30, "sin nodo", None), (31, "lejos", 99)]
    c = [(i, f"c{i}", i % 6) for i in range(15)] + [(2, "c2", 2), (None, "sin id", 1), (40, "sin nodo", None), (41, "isla", 7)]
    e = [(0, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0), (3, 4, 1.0), (6, 7, 1.0)]
    df = lambda x: spark.createDataFrame(x, "id long, nombre string, osm_node_id long")
    vias = spark.createDataFrame(e, "src long, dst long, distancia double")
    hay = defaultdict(list)
    for x in paths.rutas_entre_anclas(df(r), df(c), vias).collect():
        hay[x[0], x[2]].append(x[4])
    esperado = [(a, n, b, k, s, "SIN RUTA" if s is None else "CONECTADO") for a, n, _ in r for b, k, _ in c
                for s in (None in (a, b) and [None] or hay.get((a, b), [None]))]
    m = paths.matriz_conectividad(df(r), df(c), vias, bloque=bloque)
    clave = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, m.collect()), key=clave) == sorted(((*x[:4], x[4] or 0, x[5]) for x in esperado), key=clave)
    # pairs are made by the last join, from copies of the two sides: no join, and no shuffle, takes pairs in
    plan = m._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "_a#" in next(x for x in plan if "Join" in x)


def _mapa(spark, largo=400):
    """A strip of two rows, one long segment in it, and places of its nodes: one is given twice, one has no segment."""
    e = [(i, i + 1, 1.0 + i % 3) for i in range(largo)] + [(1000 + i, 1001 + i, 2.0) for i in range(largo)]
    e += [(i, 1000 + i, 1.0 + i % 2) for i in range(0, largo, 3)] + [(20, 28, 90.0)]
    lugares = [(f * 1000 + i, 0.001 * f, 0.001 * i) for f in (0, 1) for i in range(largo + 1)]
    return e, lugares + [lugares[5], (777, 0.0, 0.0), (778, None, 0.0)]


def _nodos(spark, lugares):
    return spark.createDataFrame(lugares, "id long, lat double, lon double")


def test_red_cercana(spark):
    """Only the map around the origins is searched, and the answers are those of the whole map."""
    e, lugares = _mapa(spark)
    red, nodos = _df(spark, e), _nodos(spark, lugares)
    o = spark.createDataFrame([(10,), (1200,), (777,), (None,)], "origen long")
    cerca = paths.red_cercana(o, red, nodos, 4)
    # four segments cover at most 32 places of 0.001, so cells are as wide: three around each origin
    assert 100 < cerca.count() < 0.6 * len(e)
    assert filas(paths.etiquetas(o, cerca, "saltos", 4).filter("origen IS NOT NULL")) == filas(
        paths.etiquetas(o, red, "saltos", 4).filter("origen IS NOT NULL"))
    assert filas(paths.saltos_entre(o.na.drop(), cerca, 4)) == filas(paths.saltos_entre(o.na.drop(), red, 4))
    assert paths.red_cercana(o.limit(0), red, nodos, 4).isEmpty()
    assert paths.red_cercana(o, red.limit(0), nodos, 4).isEmpty()


@pytest.mark.parametrize("malo", [(10, None, 0.0), (10, float("nan"), 0.01), (10, 5.0, 0.01), None])
def test_red_sin_lugar(spark, malo):
    """A segment to a node without a place, or with two, leads anywhere: then nothing is left out."""
    e, lugares = _mapa(spark, 40)
    nodos = _nodos(spark, lugares + [malo] if malo else [x for x in lugares if x[0] != 10])
    assert paths.entorno(nodos, _df(spark, e), 4) is None
    o = spark.createDataFrame([(0,)], "origen long")
    assert paths.red_cercana(o, _df(spark, e), nodos, 4).count() == len(e)


def test_pares_en_el_mapa(spark):
    """Pairs beyond reach are not searched; ways, halves and reports are the same with the places of the nodes and without."""
    e, lugares = _mapa(spark)
    red, nodos = _df(spark, e), _nodos(spark, lugares)
    pares = [(a, b) for a in (0, 18, 150, 777, 778, 9999) for b in (0, 3, 28, 149, 155, 1150, 390, 777, 778, 9999)]
    df = spark.createDataFrame(pares + [(None, 3), (3, None)], "origen long, destino long")
    cerca = paths.entorno(nodos, red, 6).pares(df)
    assert {(150, 149), (18, 28), (778, 778), (9999, 9999)} <= set(filas(cerca)) and cerca.count() < 25
    columnas = ("origen", "destino", "num_calles", "distancia", "calles")
    for f in (paths.ruta_mas_corta, paths.ruta_por_tramos):
        assert filas(f(df, red, 6, nodos=nodos), *columnas) == filas(f(df, red, 6), *columnas)
    con, sin = paths.entre_pares(df, red, 6, nodos), paths.entre_pares(df, red, 6)
    assert filas(con.pares) == filas(sin.pares)
    # ends that no pair needs have no labels
    assert {x.origen for x in con.et.select("origen").distinct().collect()} < {x.origen for x in sin.et.select("origen").distinct().collect()}
    assert not con.et.filter("origen = 390").count() and sin.et.filter("origen = 390").count()
    r = spark.createDataFrame([(1, "r1", 18), (2, "r2", 777), (3, "r3", 18)], "id long, nombre string, osm_node_id long")
    c = spark.createDataFrame([(1, "c1", 28), (2, "c2", 390), (3, "c3", 777)], "id long, nombre string, osm_node_id long")
    assert filas(paths.alcances(r, c, red, 6, nodos)) == filas(paths.alcances(r, c, red, 6))
    assert filas(paths.matriz_conectividad(r, c, red, 6, nodos=nodos)) == filas(paths.matriz_conectividad(r, c, red, 6))


def _ceros(azar):
    """Segments of no length, of equal lengths and of lengths that are no whole numbers; a part of its own."""
    return [(a, b, [0.0, 0.1, 0.2, 0.3, w][(a * 7 + b) % 5]) for a, b, w in azar] + [(300 + i, 301 + i, 0.7) for i in range(20)]


def test_menor_distancia_en_tarea_como_en_rondas(spark, azar, monkeypatch):
    """Whole paths, ties included, repeated pairs and other columns; nodes without a segment or an id."""
    red = _df(spark, _ceros(azar) + [(None, 3, 1.0), (3, None, 1.0)])
    pares = [(a, b, f"{a}-{b}") for a in (0, 7, 99, 305, 1234) for b in (*range(0, 60, 3), 99, 300, 320, 1234)]
    df = spark.createDataFrame(pares + pares[:3] + [(None, 3, "x"), (3, None, "y")], "origen long, destino long, que string")
    c = ["origen", "destino", "que", "num_calles", "distancia", "calles"]
    en_tarea = filas(paths.ruta_menor_distancia(df, red), *c)
    monkeypatch.setattr(paths.vecinal, "TRAMOS_EN_TAREA", 0)
    en_rondas = paths.ruta_menor_distancia(df, red)
    assert en_rondas.columns == paths.ruta_menor_distancia(df, red).columns and filas(en_rondas, *c) == en_tarea
    assert len(en_tarea) > 60


def test_menor_distancia_por_lotes(azar, monkeypatch):
    """Few origins a search and few nodes a batch give the same rows."""
    import numpy as np
    import pyarrow as pa
    from comanda.operators import vecinal

    e = [(a, b, w) for a, b, w in _ceros(azar) if a != b]
    peso = {}
    for a, b, w in e + [(b, a, w) for a, b, w in e]:
        peso[a, b] = min(w, peso.get((a, b), w))
    red = vecinal.Red(np.array([a for a, _ in peso]), np.array([b for _, b in peso]), np.array(list(peso.values())))
    pares = pa.table({"origen": [a for a in (0, 7, 99) for _ in range(60)], "destino": list(range(60)) * 3})
    todas = lambda: sorted((tuple(r.values()) for b in vecinal._responder(red, pares) for r in b.to_pylist()), key=repr)
    juntas = todas()
    monkeypatch.setattr(vecinal, "ETIQUETAS_POR_BUSQUEDA", 1)
    monkeypatch.setattr(vecinal, "NODOS_POR_LOTE", 7)
    assert todas() == juntas and len(juntas) > 100
    assert all(b.num_rows == 1 or sum(map(len, b["calles"].to_pylist())) <= 20 for b in vecinal._responder(red, pares))
    for o, d, saltos, metros, calles in juntas:
        assert _dijkstra(e, o, "distancia")[d] == (metros, saltos)
        assert calles[0] == o and calles[-1] == d and len(calles) == saltos + 1


def test_menor_distancia_larga_en_pocos_trabajos(spark):
    """A path of 600 segments is no 60 rounds of jobs, twice."""
    tira = [(i, i + 1, 1.0 + i % 3) for i in range(600)]
    df = spark.createDataFrame([(0, 600), (300, 10)], "origen long, destino long")
    spark.sparkContext.setJobGroup("menor", "menor")
    try:
        r = {x.origen: (x.num_calles, x.distancia, len(x.calles)) for x in paths.ruta_menor_distancia(df, _df(spark, tira)).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert r == {0: (600, sum(w for *_, w in tira), 601), 300: (290, sum(w for *_, w in tira[10:300]), 291)}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("menor")) < 30


def test_matriz_sin_difusion(spark):
    """The copies of a side for the blocks of the other one, of which files tell nothing, do not go through the driver."""
    ancla = "id", "concat('r', id) AS nombre", "id % 3 AS osm_node_id"
    vias = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0)], "src long, dst long, distancia double")
    m = paths.matriz_conectividad(spark.range(40).selectExpr(*ancla), spark.range(50).selectExpr(*ancla), vias, bloque=5)
    plan = m._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan and m.count() == 2000


@pytest.mark.parametrize("con_lugares", [False, True])
def test_par_de_un_nodo_no_se_busca(spark, con_lugares):
    """A node and itself is answered without a search; ends of other pairs are searched, and ways and halves are whole."""
    e, lugares = _mapa(spark)
    red, nodos = _df(spark, e), _nodos(spark, lugares) if con_lugares else None
    pares = [(i, i) for i in (*range(100, 160), 777, 9999)] + [(200, 206), (200, 200), (206, 1203), (100, 390), (None, 3), (3, None)]
    t = paths.entre_pares(spark.createDataFrame(pares + pares[:5], "origen long, destino long"), red, 20, nodos)
    cuantas = {r[0]: r[1] for r in t.et.groupBy("origen").count().collect() if r[0] is not None}
    assert all(cuantas[i] == 1 for i in (*range(101, 160), 777, 9999)) and cuantas[200] > 20 and cuantas[206] > 20
    hallados = {(x.origen, x.destino): (x.saltos, x.distancia) for x in t.pares.collect()}
    buenos = {p: c for p in pares if None not in p and (c := _dijkstra(e, p[0], "saltos").get(p[1], p[0] == p[1] and (0, 0.0))) and c[0] <= 20}
    assert hallados == buenos and t.pares.count() == len(buenos)
    c = paths.caminos_de_trayectos(spark.createDataFrame([p for p in pares if None not in p], "origen long, destino long"), t)
    assert {(x.origen, x.destino): (x.calles[0], x.calles[-1], len(x.calles)) for x in c.collect()} == {
        (a, b): (a, b, s + 1) for (a, b), (s, _) in buenos.items()}


def test_pedidos_de_entrega_una_vez(spark, carpeta):
    """What reads the orders to deliver after their assignment does not read all order lines again."""
    from comanda.plans.consultas import Almacen
    from comanda.sources.derivadas import Dominio

    a = Almacen(Dominio(spark, carpeta))
    assert a.asignados.count() and not [f for f in a.asignados.inputFiles() if "lineitem" in f]
