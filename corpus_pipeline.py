"""Corpus pipeline: quality, language, near duplicates, benchmark passages, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and reread as the next
stage's ``docs``; all but the last return the columns they got, and work on every row their predecessor kept.
"""

from __future__ import annotations

import public_tokenizers as vocabularios
from pyspark.sql import DataFrame, SparkSession

from comanda.llm import bpe, descontaminacion, idioma, reglas, simhash
from comanda.llm.comun import leer
from comanda.plans.durable import Corte

#: A text whose best language is less probable than this has none.  Pooled over bytes, prose lies well above.
PUNTOS_IDIOMA = 0.35
#: With many languages all of them get small probabilities, so the bound is at most so many times an equal share.
VECES_IGUAL = 1.4


def calidad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the weighed rules keep."""
    return reglas.buenos(docs)


def umbral(idiomas: int) -> float:
    """Least probability of a text's language, among so many."""
    return min(PUNTOS_IDIOMA, VECES_IGUAL / idiomas)


def lengua(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a language; the network learns from a bounded sample of the rows that name theirs.  Where no
    row does, there is nothing to decide by and all rows stay."""
    red = idioma.entrenar(idioma.muestra(docs))
    if not red.clases:
        return docs
    m = idioma.predecir(docs, red)
    return m.filter((m["idioma"] != idioma.SIN_IDIOMA) & (m["puntos"] >= umbral(len(red.clases)))).select("fila.*")


def sin_copias(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: three-word shingles, three bits."""
    return simhash.uno_por_grupo(docs, k=3, distancia=3)


def sin_pruebas(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that benchmark passages do not contaminate."""
    return descontaminacion.limpios(docs, leer(spark, sf_dir, "benchmark"))


def ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every text, decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids are written in between: one job that did both would take two Python workers a task, whose idle half holds
    its memory on while later stages run.
    """
    rangos, patron = vocabularios.path("byte_bpe_50k.tiktoken"), vocabularios.PATTERN
    escritos, _ = Corte(spark, "ids_bpe").guardar(bpe.codificar(docs, rangos, patron))
    return bpe.resumir(escritos, rangos)


STAGES = [("calidad", calidad), ("lengua", lengua), ("sin_copias", sin_copias), ("sin_pruebas", sin_pruebas),
          ("ids", ids)]

#: SQL has neither the language network nor XXH64 fingerprints; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = leer(spark, sf_dir, "documents")
    corte = Corte(spark, "pipeline")
    for _, etapa in STAGES:
        docs, _ = corte.guardar(etapa(spark, docs, sf_dir))
    return docs
