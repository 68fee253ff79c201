"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy.

A text is read as runs of letters (A-Z as a-z, and every byte beyond ASCII), cut at ``LARGO`` bytes.  A run
is one sequence of the network, which labels every byte of it; a document's probabilities are the mean of the
labels of all its bytes.  A run that repeats is read once and counted as often as it stands.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from comanda.llm.comun import ES_PALABRA, Palabras, como_fila, cortar, minusculas, por_trabajador, textos

LARGO = 16
SIN_IDIOMA = "und"
ES_LETRA = ES_PALABRA.copy()
ES_LETRA[ord("0"): ord("9") + 1] = False
_UNA_LETRA = regex.compile(r"\p{L}")

#: Bounds of the training sample: documents of each language, distinct runs of each, for so many languages.
#: With more languages each one gets a smaller share; none is left out.
DOCUMENTOS = 300
RUNS = 4000
IDIOMAS = 64
#: Runs whose labels a task remembers (as hash and one number a language), up to ``IDIOMAS`` languages.
RECUERDA = 500_000


def _sig(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def a_bytes(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(T, n) matrix of byte + 1, 0 beyond the end, and the lengths."""
    largo = np.array([len(r) for r in runs], np.int64)
    m = np.zeros((int(largo.max(initial=0)), len(runs)), np.int64)
    plano = np.frombuffer(b"".join(runs), np.uint8).astype(np.int64) + 1
    col = np.repeat(np.arange(len(runs)), largo)
    m[np.arange(len(plano)) - np.repeat(np.cumsum(largo) - largo, largo), col] = plano
    return m, largo


class Red:
    """Two GRUs (forward, backward) and a linear layer on both states at every position."""

    def __init__(self, clases: list[str], estado: int = 12, semilla: int = 7):
        g = np.random.default_rng(semilla)
        self.clases, self.h = clases, estado
        f = lambda *n: (g.standard_normal(n) / np.sqrt(estado)).astype(np.float32)
        # per direction: input table (byte to three gates), recurrent weights; gate order z, r, candidate
        self.p = {f"{k}{d}": v for d in "ab" for k, v in
                  (("E", f(257, 3 * estado)), ("U", f(estado, 2 * estado)), ("V", f(estado, estado)))}
        self.p |= {"O": f(2 * estado, len(clases)), "o": np.zeros(len(clases), np.float32)}

    def _recorrer(self, x: np.ndarray, d: str, guarda: bool) -> tuple[np.ndarray, list]:
        n, e = x.shape[1], self.h
        E, U, V = self.p["E" + d], self.p["U" + d], self.p["V" + d]
        h = np.zeros((n, e), np.float32)
        estados, cinta = np.empty((x.shape[0], n, e), np.float32), []
        parejas = not guarda and bool(x.all())  # all runs of one length
        for t in range(x.shape[0]) if d == "a" else range(x.shape[0] - 1, -1, -1):
            g = E[x[t]]
            zr = _sig(g[:, :2 * e] + h @ U)
            z, r = zr[:, :e], zr[:, e:]
            c = np.tanh(g[:, 2 * e:] + (r * h) @ V)
            nuevo = h + z * (c - h)
            if parejas:
                vivo = None
            else:
                vivo = (x[t] > 0)[:, None]
                nuevo = np.where(vivo, nuevo, h)
            if guarda:
                cinta.append((t, h, z, r, c, vivo))
            h = nuevo
            estados[t] = h
        return estados, cinta

    def etiquetas(self, x: np.ndarray) -> np.ndarray:
        """(T, n, classes): probabilities at every position."""
        s = np.concatenate([self._recorrer(x, "a", False)[0], self._recorrer(x, "b", False)[0]], axis=2)
        y = s @ self.p["O"] + self.p["o"]
        y = np.exp(y - y.max(axis=2, keepdims=True))
        return y / y.sum(axis=2, keepdims=True)

    def gradientes(self, x: np.ndarray, y: np.ndarray, peso: np.ndarray) -> tuple[float, dict]:
        """Mean loss over all positions and its gradients, by backpropagation through time."""
        p, e = self.p, self.h
        sa, ca = self._recorrer(x, "a", True)
        sb, cb = self._recorrer(x, "b", True)
        s = np.concatenate([sa, sb], axis=2)
        q = s @ p["O"] + p["o"]
        q = np.exp(q - q.max(axis=2, keepdims=True))
        q /= q.sum(axis=2, keepdims=True)
        w = ((x > 0) * peso[None, :]).astype(np.float32)
        w /= max(float(w.sum()), 1e-9)
        n = np.arange(x.shape[1])
        perdida = float(-(w * np.log(q[:, n, y] + 1e-9)).sum())
        dq = q.copy()
        dq[:, n, y] -= 1
        dq *= w[:, :, None]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["O"] = np.einsum("tne,tnc->ec", s, dq)
        g["o"] = dq.sum(axis=(0, 1))
        ds = dq @ p["O"].T
        for d, cinta, parte in (("a", ca, ds[:, :, :e]), ("b", cb, ds[:, :, e:])):
            U, V = p["U" + d], p["V" + d]
            dh = np.zeros((x.shape[1], e), np.float32)
            for t, h, z, r, c, vivo in reversed(cinta):
                dh = dh + parte[t]
                dn = np.where(vivo, dh, 0)
                dc = dn * z * (1 - c * c)
                dz = dn * (c - h) * z * (1 - z)
                drh = dc @ V.T
                dr = drh * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                g["U" + d] += h.T @ dzr
                g["V" + d] += (r * h).T @ dc
                np.add.at(g["E" + d], x[t], np.concatenate([dzr, dc], axis=1) * vivo)
                dh = np.where(vivo, dn * (1 - z) + drh * r + dzr @ U.T, dh)
        return perdida, g


def entrenar(ejemplos: list[tuple[str, bytes, int]], vueltas: int = 6, lote: int = 512, paso: float = 0.01,
             estado: int = 12) -> Red:
    """Network from (language, run, count).  Every language weighs the same; order and start are fixed."""
    clases = sorted({i for i, _, _ in ejemplos})
    red = Red(clases, estado)
    if not ejemplos:
        return red
    ejemplos = sorted(ejemplos)
    lugar = {c: k for k, c in enumerate(clases)}
    y = np.array([lugar[i] for i, _, _ in ejemplos])
    n = np.array([c for _, _, c in ejemplos], np.float64)
    peso = n / np.bincount(y, n)[y]
    peso = (peso / peso.mean()).astype(np.float32)
    todas = [r for _, r, _ in ejemplos]
    g = np.random.default_rng(11)
    m = {k: np.zeros_like(v) for k, v in red.p.items()}
    v = {k: np.zeros_like(x) for k, x in red.p.items()}
    k = 0
    pasos = vueltas * -(-len(todas) // lote)
    for _ in range(vueltas):
        orden = g.permutation(len(todas))
        for a in range(0, len(orden), lote):
            parte = orden[a: a + lote]
            x, _ = a_bytes([todas[i] for i in parte])
            _, gr = red.gradientes(x, y[parte], peso[parte])
            k += 1
            tasa = paso * (1 - (k - 1) / pasos)
            for c in red.p:  # Adam
                m[c] = 0.9 * m[c] + 0.1 * gr[c]
                v[c] = 0.99 * v[c] + 0.01 * gr[c] ** 2
                red.p[c] = (red.p[c] - tasa * (m[c] / (1 - 0.9 ** k)) / (np.sqrt(v[c] / (1 - 0.99 ** k)) + 1e-8)) \
                    .astype(np.float32)
    return red


class Runs:
    """Runs of a batch of texts, none longer than ``LARGO`` bytes, each with its text and its hash."""

    def __init__(self, t: pa.Array):
        p = Palabras(t, ES_LETRA)
        n = -(-(p.fin - p.ini) // LARGO)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.datos, self.n = p.datos, len(t)
        self.ini = np.repeat(p.ini, n) + k * LARGO
        self.fin = np.minimum(self.ini + LARGO, np.repeat(p.fin, n))
        self.doc = np.repeat(p.doc, n)
        # the pieces of a long run are told apart by hashing each on its own
        self.h = np.repeat(p.huellas(), n)
        for i in np.flatnonzero(np.repeat(n > 1, n)).tolist():
            self.h[i] = xxhash.xxh64_intdigest(self.datos[self.ini[i]: self.fin[i]].tobytes())

    def bytes(self, i: int) -> bytes:
        return self.datos[self.ini[i]: self.fin[i]].tobytes()


def _primeras(df: DataFrame, orden: list, n: int) -> DataFrame:
    """First ``n`` rows of each language ``i``: of each of 64 parts of a language first, so that a language
    with most of the rows is sorted in many tasks and at most 64 * n of its rows meet in one."""
    salida = df.withColumn("parte", F.pmod(F.xxhash64(*[c for c in df.columns if c != "i"]), F.lit(64)))
    for grupo in (["i", "parte"], ["i"]):
        salida = (salida.withColumn("k", F.row_number().over(Window.partitionBy(*grupo).orderBy(*orden)))
                  .filter(F.col("k") <= n).drop("k"))
    return salida.drop("parte")


def muestra(docs: DataFrame, texto: str = "text", idioma: str = "lang", documentos: int = DOCUMENTOS,
            runs: int = RUNS, idiomas: int = IDIOMAS) -> list[tuple[str, bytes, int]]:
    """(language, run, count) to train on, of every language at least one run; at most ``idiomas * runs`` rows,
    or one a language where there are more languages than that.

    Of each language ``documentos`` texts, chosen by the hash of the text, and of these the ``runs`` most
    frequent runs; beyond ``idiomas`` languages both numbers are cut in proportion.  All rows are candidates.
    """
    d = docs.select(F.col(idioma).alias("i"), F.col(texto).alias("t")).filter("i IS NOT NULL AND t IS NOT NULL")
    d = d.withColumn("h", F.xxhash64("t"))
    # a language without a letter in any text adds no run and no class
    hay = d.select("i").distinct().count()
    if not hay:
        return []
    documentos, runs = (min(x, max(1, x * idiomas // hay)) for x in (documentos, runs))
    elegidos = _primeras(d.select("i", "h").distinct(), ["h"], documentos)
    r = (d.join(F.broadcast(elegidos), ["i", "h"])
         .select("i", F.explode(F.regexp_extract_all(minusculas(F.col("t")), F.lit(r"[a-z\x{80}-\x{10FFFF}]+"),
                                                      F.lit(0))).alias("r"))
         .withColumn("r", F.col("r").cast("binary"))
         # the pieces that ``Runs`` makes, so that all of a run is learnt
         .select("i", F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.length("r") - 1) / LARGO).cast("int")),
                                            lambda k: F.substring(F.col("r"), k * LARGO + 1, F.lit(LARGO)))).alias("r"))
         .groupBy("i", "r").agg(F.count("*").alias("n")))
    r = _primeras(r, [F.desc("n"), "r"], runs)
    return [(x.i, bytes(x.r), x.n) for x in r.collect()]


class Lector:
    """Predicts with a network; remembers the summed labels of runs over batches and tasks."""

    def __init__(self, red: Red):
        self.red = red
        self.claves = np.zeros(0, np.uint64)
        self.sumas = np.zeros((0, len(red.clases)), np.float32)

    def _leer(self, runs: list[bytes]) -> np.ndarray:
        """(len(runs), classes): labels summed over the bytes of each run; runs of one length go together."""
        salida = np.zeros((len(runs), len(self.red.clases)), np.float32)
        largo = np.array([len(r) for r in runs])
        for n in np.unique(largo):
            de = np.flatnonzero(largo == n)
            juntos = max(1, 1024 * IDIOMAS // max(IDIOMAS, len(self.red.clases)))
            for a in range(0, len(de), juntos):
                parte = de[a: a + juntos]
                salida[parte] = self.red.etiquetas(a_bytes([runs[i] for i in parte])[0]).sum(axis=0)
        return salida

    def probabilidades(self, t: pa.Array) -> np.ndarray:
        """(texts, classes): mean label over all bytes of all runs; zeros for a text without a run."""
        r = Runs(t)
        claves, uno, cual = np.unique(r.h, return_index=True, return_inverse=True)
        lugar = np.minimum(np.searchsorted(self.claves, claves), max(0, len(self.claves) - 1))
        falta = self.claves[lugar] != claves if len(self.claves) else np.ones(len(claves), bool)
        valores = np.zeros((len(claves), len(self.red.clases)), np.float32)
        if len(self.claves):
            valores[~falta] = self.sumas[lugar[~falta]]
        if falta.any():
            valores[falta] = self._leer([r.bytes(i) for i in uno[falta].tolist()])
            if len(self.claves) + falta.sum() > RECUERDA * IDIOMAS // max(IDIOMAS, len(self.red.clases)):
                self.claves, self.sumas = self.claves[:0], self.sumas[:0]
            todas = np.concatenate([self.claves, claves[falta]])
            orden = np.argsort(todas, kind="stable")
            self.claves, self.sumas = todas[orden], np.concatenate([self.sumas, valores[falta]])[orden]
        suma = np.stack([np.bincount(r.doc, valores[cual, j], minlength=r.n) for j in range(valores.shape[1])], axis=1)
        letras = np.bincount(r.doc, r.fin - r.ini, minlength=r.n)
        return suma / np.maximum(letras, 1)[:, None]


def predecir(docs: DataFrame, red: Red, texto: str = "text") -> DataFrame:
    """``fila`` (the input row), ``idioma`` and ``puntos``, the pooled probability of that language.

    Reads nothing but the text.  Null text, a text without a letter and a network without classes give
    ``und`` with score 0.  Row by row, so copies and repeated rows get the same answer.
    """
    campo = docs.columns.index(texto)
    tipo = StructType([StructField("fila", docs.schema, False), StructField("idioma", StringType()),
                       StructField("puntos", DoubleType())])
    caja = docs.sparkSession.sparkContext.broadcast(red)
    marca = uuid.uuid4().hex

    def paso(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lector = por_trabajador(("lector", marca), lambda: Lector(caja.value))
        clases = np.array([*lector.red.clases, SIN_IDIOMA], object)
        for lote in (x for y in lotes for x in cortar(y, campo)):
            t = textos(lote, campo)
            con = np.array([bool(_UNA_LETRA.search(x)) for x in t.to_pylist()]) & (len(clases) > 1)
            q = lector.probabilidades(t) if len(clases) > 1 else np.zeros((len(t), 1))
            cual = np.where(con, q.argmax(axis=1), len(clases) - 1)
            puntos = np.where(con, np.clip(q.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [lote.column(0), pa.array(clases[cual], pa.string()), pa.array(puntos, pa.float64())],
                ["fila", "idioma", "puntos"])

    return como_fila(docs).mapInArrow(paso, tipo)
