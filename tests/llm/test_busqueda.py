"""Top-k search, run detection and whitening against brute force."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from comanda.llm import blanqueo, consultas, mejores, oraculo, periodos

NO_BLANCO = bytes(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)


def palabras(t):
    return [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in t or "").split(" ") if w]


# ---- runs ------------------------------------------------------------------------------------------------------------

def corridas(w, minimo=6, veces=4):
    """Every stretch of each distance; a multiple of a period has the same stretch."""
    hay = {}
    for q in range(1, len(w) // veces + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(minimo, veces * q) and i > s:
                hay.setdefault((s, i - s + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in hay.items()), key=lambda r: (r[0], r[2]))


def colapsado(w, runs):
    fuera = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in fuera)


@pytest.mark.parametrize("minimo,veces", [(6, 4), (2, 2), (3, 3)])
@pytest.mark.parametrize("saltos", [0, 12])
def test_corridas_al_azar(minimo, veces, saltos, monkeypatch):
    monkeypatch.setattr(periodos, "SALTOS", saltos)
    azar = random.Random(minimo)
    for _ in range(400):
        textos = []
        for _ in range(azar.randint(0, 4)):
            w = [azar.randrange(azar.randint(1, 3)) for _ in range(azar.randint(0, 40))]
            if azar.random() < 0.5:
                w[len(w) // 2:len(w) // 2] = [azar.randrange(3) for _ in range(azar.randint(1, 5))] * azar.randint(1, 9)
            textos.append(w)
        esperadas, base = [], 0
        for w in textos:
            esperadas += [(s + base, n, q) for s, n, q in corridas(w, minimo, veces)]
            base += len(w)
        r = periodos.corridas(np.array([x for w in textos for x in w], np.int64),
                              np.array([i for i, w in enumerate(textos) for _ in w], np.int64), minimo, veces)
        assert [tuple(x) for x in r.tolist()] == esperadas


def test_sufijos():
    azar = np.random.default_rng(4)
    palabra = azar.integers(0, 3, 300)
    texto = np.repeat([0, 2, 3], 100)
    sa, isa, lcp = periodos.sufijos(palabra, texto)
    colas = [(texto[i], *palabra[i: 100 * (i // 100 + 1)]) for i in range(300)]
    assert sa.tolist() == sorted(range(300), key=lambda i: colas[i])
    assert (isa[sa] == np.arange(300)).all()
    for k in range(1, 300):
        a, b = colas[sa[k - 1]], colas[sa[k]]
        n = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == max(0, n - 1)


TEXTOS = [None, "", " \n\t ", "a", "a " * 6, "a " * 5, "no no no no no no yes yes yes", "x y " * 4 + "x", "A a " * 6 + "z",
          "uno  dos\ttres\n" * 9 + "fin", "él 世界 " * 300, ("b " * 7 + "c ") * 5, " ".join(f"w{i % 5003}" for i in range(60_000)),
          "ab " * 100_000, "w" * 50_000, "one two three four five six seven eight nine ten. " * 3]


@pytest.fixture(scope="module")
def docs(spark):
    filas = [(i, t, 1, "x", 2) for i, t in enumerate(TEXTOS)] + [(4, TEXTOS[4], 1, "x", 2), (None, TEXTOS[6], 1, "x", 2)]
    return spark.createDataFrame(filas, "doc_id bigint, text string, n int, corridas string, fila int").repartition(3)


def test_periodos(docs):
    r = periodos.buscar(docs).collect()
    assert len(r) == docs.count()
    for x in r:
        w = palabras(x["fila"]["text"])
        # a stretch of 60,000 words without period needs no trial of each distance
        runs = corridas(w) if len(w) < 20_000 else [(0, len(w), 1)] if len(set(w)) == 1 else [(0, len(w), 5003)]
        assert x["n_palabras"] == len(w)
        assert [tuple(c) for c in x["corridas"]] == runs
        assert x["sin_repetir"] == colapsado(w, runs)
    vacia = periodos.buscar(docs.limit(0))
    assert vacia.count() == 0 and vacia.columns == ["fila", "n_palabras", "corridas", "sin_repetir"]


def test_op12_fuerza_bruta(spark, carpeta):
    textos = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{carpeta}/documents.parquet").collect()}
    r = {x["doc_id"]: x for x in consultas.op12_periodos(spark, carpeta).collect()}
    assert r.keys() == textos.keys()
    con_runs = 0
    for k, t in textos.items():
        w, h = palabras(t), zlib.crc32(str(k).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = corridas(w)
        con_runs += bool(runs)
        x = r[k]
        una = min(runs, key=lambda c: (-c[1] / c[2], c[0], c[2]), default=None)
        assert (x["start"], x["length"], x["period"]) == (una or (None, None, None))
        assert x["exponent_milli"] == (1000 * una[1] // una[2] if una else None)
        assert x["n_runs"] == len(runs)
        lineas = "".join("%d,%d,%d\n" % c for c in runs)
        assert x["runs_sha256"] == hashlib.sha256(lineas.encode()).hexdigest()
        assert x["collapsed_sha256"] == hashlib.sha256(colapsado(w, runs).encode()).hexdigest()
    assert con_runs > 5


def test_op12_sin_texto(spark, tmp_path):
    """Null ids and texts, and a table without rows."""
    filas = [(None, "a " * 8), (1, None), (2, "")] + [(i, "p q r " * 6) for i in range(60)]
    for nombre, f in (("algo", filas), ("nada", [])):
        spark.createDataFrame(f, "doc_id bigint, text string").write.parquet(f"{tmp_path}/{nombre}/documents.parquet")
        r = consultas.op12_periodos(spark, f"{tmp_path}/{nombre}").collect()
        assert len(r) == len(f)
        assert all(x["collapsed_sha256"] and x["runs_sha256"] for x in r)


# ---- top-k -----------------------------------------------------------------------------------------------------------

def k_mejores(filas, consulta, k):
    filas = list(dict.fromkeys((i, tuple(v)) for i, v in filas))
    salida = []
    for i, q in filas:
        if i is None or not consulta(i):
            continue
        c = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for j, v in filas if j != i]
        salida += [(i, r + 1, x[3], max(-2**63, min(2**63 - 1, -x[0]))) for r, x in enumerate(sorted(c)[:k])]
    return sorted(salida, key=repr)


@pytest.mark.parametrize("ancho", [1, 3, 17])
def test_listas_paran(ancho):
    """The lists give the best rows and stop before their ends where one row stands out."""
    azar = np.random.default_rng(ancho)
    x = azar.integers(-50, 50, (3000, ancho))
    x[100] = 1000
    x[200] = -1000
    listas, q = mejores.Listas(x), np.full(ancho, 3)
    filas, puntos, leidas = listas.mejores(q, 1, None, np.int64)
    assert filas.tolist() == [100] and puntos.tolist() == [3000 * ancho] and leidas < 3000
    assert listas.mejores(q, 1, 3000 * ancho + 1, np.int64)[2] == 0
    for _ in range(50):
        q = azar.integers(-3, 4, ancho)
        filas, puntos, _ = listas.mejores(q, 7, None, np.float64)
        orden = np.lexsort((np.arange(3000), -(x @ q)))[:7]
        assert sorted(filas.tolist()) == sorted(orden.tolist()) and sorted(puntos) == sorted((x @ q)[orden])


@pytest.mark.parametrize("caso", ["azar", "copias", "raros", "pocos", "enormes"])
def test_mejores(spark, caso, monkeypatch):
    azar = random.Random(caso)
    al_azar = lambda n, d, m: [(i, [azar.randint(-m, m) for _ in range(d)]) for i in range(n)]
    filas = {
        # more than one block, several groups of queries and of candidates
        "azar": al_azar(700, 6, 9),
        # a third of all rows are one vector, and ties everywhere
        "copias": [(i, [1, 2, 3] if i % 3 == 0 else [i % 4, 1, -(i % 2)]) for i in range(500)],
        "raros": [(None, [5, 5]), (None, [5, 5]), (None, [1]), (0, []), (10, [0, 0]), (20, [1, 1, 7]), (30, [-1]), (30, [4]),
                  (7, [2, 2]), (7, [2, 2]), (20, [1, 1, 7]), (40, [0, 0, 0, 0])],
        "pocos": [(10, [1, 2]), (11, [2, 1])],
        "enormes": [(i, [azar.choice((-1, 1)) * (1 << 62), azar.randint(-9, 9), 1 << 40]) for i in range(60)],
    }[caso]
    monkeypatch.setattr(mejores, "BLOQUE", 600)
    monkeypatch.setattr(mejores, "CONSULTAS", 90)
    monkeypatch.setattr(mejores, "CANDIDATOS", 1500)
    df = spark.createDataFrame([(i, v, "x") for i, v in filas], "id bigint, v array<bigint>, clave string").repartition(3)
    r = mejores.mejores(df, F.col("id") % 10 == 0, 5)
    assert sorted(map(tuple, r.collect()), key=repr) == k_mejores(filas, lambda i: i % 10 == 0, 5)


def test_mejores_sin_filas(spark):
    df = spark.createDataFrame([(1, [1, 2])], "id bigint, v array<bigint>")
    assert mejores.mejores(df.limit(0), F.col("id") == 1, 3).count() == 0
    assert mejores.mejores(df, F.col("id") == 2, 3).count() == 0
    assert mejores.mejores(df, F.col("id") == 1, 3).count() == 0


def _vectores(spark, carpeta, filas):
    spark.createDataFrame(filas, "vec_id bigint, embedding array<float>, label int").write.parquet(
        f"{carpeta}/embeddings.parquet")


NAN, INF = float("nan"), float("inf")
MALOS = [(0, None, 1), (100, [1.0, None], 1), (200, [NAN, 1.0], 1), (300, [INF, 1.0], 1), (400, [-INF, 0.0], 1)]


def test_op11_op13_malos(spark, tmp_path):
    """Rows that take no part, and a table that has no others."""
    buenos = [(500 + i, [i / 7, -i / 3], 0) for i in range(101)]
    _vectores(spark, f"{tmp_path}/a", MALOS + buenos)
    r = consultas.op11_mejores(spark, f"{tmp_path}/a").collect()
    assert {x["query_id"] for x in r} == {500, 600} and len(r) == 20
    b = consultas.op13_blanqueo(spark, f"{tmp_path}/a").collect()
    assert len(b) == 202 and {x["n"] for x in b} == {101}
    _vectores(spark, f"{tmp_path}/b", MALOS)
    assert consultas.op11_mejores(spark, f"{tmp_path}/b").count() == 0
    assert consultas.op13_blanqueo(spark, f"{tmp_path}/b").count() == 0


@pytest.mark.parametrize("nombre", ["op11_mejores", "op12_periodos"])
def test_sql(spark, carpeta, nombre):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{carpeta}/{t}.parquet')")
    df = getattr(consultas, nombre)(spark, carpeta)
    esperada = con.sql(oraculo.oraculo()[nombre]).select(", ".join(df.columns)).fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(esperada, key=repr)


# ---- whitening -------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("caso", range(9))
def test_espectro(caso):
    azar = np.random.default_rng(caso)
    giro = np.linalg.qr(azar.standard_normal((40, 40)))[0]
    a = azar.standard_normal((12, 30))
    v = [a @ a.T, a.T @ a, np.eye(5), np.zeros((4, 4)), np.ones((6, 6)), np.diag([2.0, -2, 0, 0, 1, -1]), np.array([[3.0]]),
         giro @ np.diag([1.0] * 20 + [1 + 1e-7] * 10 + [2] * 10) @ giro.T, giro @ np.diag(10.0 ** -np.arange(40)) @ giro.T][caso]
    e, q = blanqueo.espectro(v)
    escala = max(1e-300, np.linalg.norm(v))
    assert np.abs(e - np.linalg.eigvalsh(v)[::-1]).max() <= 1e-13 * escala
    assert np.abs(q.T @ q - np.eye(len(v))).max() < 1e-12
    assert np.abs(v @ q - q * e).max() <= 1e-13 * escala


def test_polar():
    a = np.random.default_rng(1).standard_normal((20, 20))
    a = a + a.T
    w, x = np.linalg.eigh(a)
    assert np.abs(blanqueo.polar(a) - (x * np.sign(w)) @ x.T).max() < 1e-12


def test_op13_fuerza_bruta(spark, carpeta):
    filas = spark.read.parquet(f"{carpeta}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r["embedding"] for r in filas], np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:32], q[:, ::-1][:, :32]
    esperado = c @ q / np.sqrt(e)
    r = consultas.op13_blanqueo(spark, carpeta).orderBy("vec_id", "component").collect()
    assert [(x["vec_id"], x["component"]) for x in r] == [(f["vec_id"], k + 1) for f in filas for k in range(32)]
    y = np.array([f["whitened"] for f in r]).reshape(n, 32)
    assert np.abs(y * np.sign((y * esperado).sum(0)) - esperado).max() < 1e-9
    assert [f["deviation"] for f in r[::32]] == ((n * x - s) ** 2).sum(1).tolist()
    assert np.abs(np.array([f["explained"] for f in r[:32]]) - e / np.trace(v)).max() < 1e-12
    assert {f["n"] for f in r} == {n} and max(f["identity_error"] for f in r) < 1e-9


def test_blanqueo_raros(spark):
    """Short and empty vectors, clashing names, repeated rows, numbers that need more than 64 bits."""
    filas = [(1, [1, 2, 3], "a"), (1, [1, 2, 3], "a"), (None, [4], "b"), (3, [], "c"), (4, [7, 7, 1], None), (5, [2, 9, 4], "d")]
    df = spark.createDataFrame(filas, "blanqueado bigint, x array<bigint>, desvio string")
    m = blanqueo.ajustar(df, 8)
    x = np.array([v + [0] * (3 - len(v)) for _, v, _ in filas])
    assert (m.n, m.sumas) == (6, x.sum(0).tolist())
    b = blanqueo.blanquear(df, m)
    r = b.collect()
    assert sorted((f["fila"]["blanqueado"], f["desvio"]) for f in r if f["fila"]["blanqueado"]) == sorted(
        (i, int(((6 * v - x.sum(0)) ** 2).sum())) for (i, _, _), v in zip(filas, x) if i)
    y = np.array([f["blanqueado"] for f in r])
    assert np.abs(y.T @ y / 6 - np.eye(3)).max() < 1e-12 and blanqueo.error_identidad(b, m) < 1e-12

    grande = spark.createDataFrame([(1, [1 << 61, 5]), (2, [-(1 << 61), 6])], "i int, x array<bigint>")
    m = blanqueo.ajustar(grande, 2)
    assert m.sumas == [0, 11]
    r = blanqueo.blanquear(grande, m).collect()
    assert [f["desvio"] for f in r] == [None, None]
    # the second direction is lost in the rounding of the first one
    assert all(f["blanqueado"][1] is None and abs(abs(f["blanqueado"][0]) - 1) < 1e-9 for f in r)


def test_blanqueo_sin_varianza(spark):
    iguales = spark.createDataFrame([(i, [3, 4]) for i in range(5)], "i int, x array<bigint>")
    m = blanqueo.ajustar(iguales, 2)
    b = blanqueo.blanquear(iguales, m)
    assert m.explicado == [None, None] and blanqueo.error_identidad(b, m) is None
    assert all(f["blanqueado"] == [None, None] and f["desvio"] == 0 for f in b.collect())
    nada = iguales.limit(0)
    m = blanqueo.ajustar(nada, 2)
    assert m.n == 0 and blanqueo.blanquear(nada, m).count() == 0
    solo = iguales.limit(1).select("i", F.array().cast("array<bigint>").alias("x"))
    m = blanqueo.ajustar(solo, 2)
    assert [tuple(f["blanqueado"]) for f in blanqueo.blanquear(solo, m).collect()] in ([()], [])
