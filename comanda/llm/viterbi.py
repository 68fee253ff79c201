"""Token counts of a unigram tokenizer: best segmentation by score, of which only the length is kept.

The vocabulary (pieces with scores) comes from a model file.  The tokenizer is the unigram model over it
with byte fallback, after blanks became U+2581 and a text was split before each of them: a word is its own
segmentation problem, and a task remembers the counts of words it has met.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from comanda.llm.comun import Memoria, como_fila, cortar, por_trabajador, textos

BLANCO = "▁"
#: What an unknown character scores below the worst piece.
CASTIGO = 10.0
NADA = float("-inf")
#: Words whose counts a task remembers.
RECUERDA = 64 << 20


def vocabulario(ruta: str) -> list[tuple[str, float]]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=ruta)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class Contador:
    """Counts pieces of the best segmentation.

    Ties follow the tokenizer: it tries starts from left to right and replaces a path only by a strictly
    better one, so of equal paths to a place the one with the longest last piece stays.  The automaton
    names the pieces that end at a place longest first, which is the same order.  A character that is no
    piece of its own can be read as unknown, tried last, and then counts as its bytes if all of them are
    pieces; else a run of unknown characters counts once.
    """

    def __init__(self, vocab: list[tuple[str, float]]):
        self.automata = ahocorasick.Automaton()
        for pieza, nota in vocab:
            if pieza:
                self.automata.add_word(pieza, (len(pieza), nota))
        self.automata.make_automaton()
        piezas = {p for p, _ in vocab}
        self.desconocido = min((n for _, n in vocab), default=0.0) - CASTIGO
        self.sueltas = {p for p in piezas if len(p) == 1}
        self.bytes = all(f"<0x{b:02X}>" in piezas for b in range(256))
        self.enteras = all(float(n).is_integer() for _, n in vocab)
        # no piece crosses a character that is in none: a text falls apart there.  Sums of whole numbers
        # are exact, so the parts' paths are those of the whole.
        letras = {c for p in piezas for c in p}
        ajenas = [c for c in "\n\t\r" if c not in letras]
        self.aparte = re.compile("([" + "".join(map(re.escape, ajenas)) + "])") if ajenas and self.enteras \
            and self.bytes else None
        self.memo = Memoria(RECUERDA)

    def texto(self, t: str) -> int:
        """Pieces of a text; an empty one has none."""
        if not t:
            return 0
        t = t.replace(" ", BLANCO)
        if t[0] != BLANCO:
            t = BLANCO + t
        m = self.memo.nuevas
        return sum([m.get(w) or self._recordada(w) for w in t[1:].split(BLANCO)])

    def _recordada(self, w: str) -> int:
        n = self.memo.get(w)
        return n if n is not None else self.memo.poner(w, self.palabra(BLANCO + w))

    def palabra(self, w: str) -> int:
        if self.aparte is None:
            return self.camino(w)
        # odd places are the separators, one byte and so one piece each
        return sum(1 if k % 2 else self.camino(x) for k, x in enumerate(self.aparte.split(w)) if x)

    def camino(self, w: str) -> int:
        n = len(w)
        nota, piezas = [0.0] + [NADA] * n, [0] * (n + 1)
        if self.sueltas.issuperset(w):  # no character is unknown
            for fin, (largo, valor) in self.automata.iter(w):
                s = nota[fin + 1 - largo] + valor
                if s > nota[fin + 1]:
                    nota[fin + 1], piezas[fin + 1] = s, piezas[fin + 1 - largo] + 1
            return piezas[n]
        ajena = [False] * (n + 1)
        hecho = 0
        for fin, (largo, valor) in self.automata.iter(w):
            fin += 1
            # ends come in order: places before this one are settled once their unknown step was tried
            while hecho < fin - 1:
                hecho += 1
                self._desconocida(w, hecho, nota, piezas, ajena)
            s = nota[fin - largo] + valor
            if s > nota[fin]:
                nota[fin], piezas[fin], ajena[fin] = s, piezas[fin - largo] + 1, False
        while hecho < n:
            hecho += 1
            self._desconocida(w, hecho, nota, piezas, ajena)
        return piezas[n]

    def _desconocida(self, w: str, fin: int, nota: list, piezas: list, ajena: list) -> None:
        c = w[fin - 1]
        if c in self.sueltas:
            return
        s = nota[fin - 1] + self.desconocido
        if s > nota[fin]:
            sigue = ajena[fin - 1] and not self.bytes
            nota[fin], ajena[fin] = s, True
            piezas[fin] = piezas[fin - 1] + (len(c.encode()) if self.bytes else 0 if sigue else 1)


def contador(ruta: str) -> Contador:
    """One per Python worker, so its memory of words lasts over tasks."""
    return por_trabajador(("contador", ruta), lambda: Contador(vocabulario(ruta)))


def contar(docs: DataFrame, ruta: str, texto: str = "text") -> DataFrame:
    """``fila`` (the input row) and ``n_piezas``.  Row by row; null or empty text has no pieces."""
    campo = docs.columns.index(texto)
    tipo = StructType([StructField("fila", docs.schema, False), StructField("n_piezas", LongType())])

    def paso(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = contador(ruta)
        for lote in (x for y in lotes for x in cortar(y, campo)):
            n = [c.texto(t) for t in textos(lote, campo).to_pylist()]
            yield pa.RecordBatch.from_arrays([lote.column(0), pa.array(n, pa.int64())], ["fila", "n_piezas"])

    return como_fila(docs).mapInArrow(paso, tipo)
