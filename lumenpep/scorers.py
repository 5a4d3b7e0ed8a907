"""Predictors of peptides that Spark doesn't have: applied to Arrow batches in tasks, their model loaded once a worker.

A scorer runs in this process (`Scorer`) or is a program that reads and writes one of the tools' formats through pipes
(`Program`); formats are pairs of functions between Arrow batches and bytes.
"""

from __future__ import annotations

import csv
import io
import subprocess
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from .sources.files import RANK

CLEAVAGE = "transcript string, pos int, p double"
RANKS = "peptide string, allele string, tool string, col_ord int, rank double"
TAP = "peptide string, tap_score double"
CNN = "fragment string, allele string, score double"
PRIME = "peptide string, prime_rank double"

_models: dict[str, Any] = {}


@dataclass(frozen=True)
class Scorer:
    """score(model, batch) gives a batch of the schema; load() makes the model, once in each worker for a name, which therefore
    tells versions apart. Spark may send a batch twice, so scores depend on the batch alone. at_once: rows a call."""

    name: str
    schema: str
    load: Callable[[], Any]
    score: Callable[[Any, pa.RecordBatch], pa.RecordBatch]
    at_once: int = 200_000

    def apply(self, df: DataFrame) -> DataFrame:
        name, load, score, at_once = self.name, self.load, self.score, self.at_once

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, batch.num_rows, at_once):
                    if name not in _models:
                        _models[name] = load()
                    yield score(_models[name], batch.slice(low, at_once))

        return df.mapInArrow(run, self.schema)


@dataclass(frozen=True)
class Format:
    """What a program reads and writes: encode a batch, decode its answer into columns of the schema."""

    schema: str
    encode: Callable[[pa.RecordBatch], bytes]
    decode: Callable[[str], dict[str, list]]


@dataclass(frozen=True)
class Program:
    """A program as a scorer: one run for each `at_once` rows, its input and answer in a format through pipes. A run that ends
    with an error fails the task, which Spark tries again."""

    argv: list[str]
    format: Format
    at_once: int = 200_000
    env: dict[str, str] | None = field(default=None)

    @property
    def schema(self) -> str:
        return self.format.schema

    def apply(self, df: DataFrame) -> DataFrame:
        argv, env, encode, decode, schema = self.argv, self.env, self.format.encode, self.format.decode, self.format.schema

        def score(_: None, batch: pa.RecordBatch) -> pa.RecordBatch:
            ran = subprocess.run(argv, input=encode(batch), capture_output=True, env=env, check=False)
            if ran.returncode:
                raise RuntimeError(f"{argv[0]} ended with {ran.returncode}: {ran.stderr.decode(errors='replace')[-2000:]}")
            found = decode(ran.stdout.decode("utf-8"))
            return pa.RecordBatch.from_arrays([pa.array(found[n], _ARROW[t]) for n, t in _fields(schema)], names=[n for n, _ in _fields(schema)])

        return Scorer(argv[0], schema, lambda: None, score, self.at_once).apply(df)


_ARROW = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}


def _fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(f.split()) for f in schema.split(", ")]


def _number(text: str | None) -> float | None:
    """The number a cell holds; null for an empty one, NA or nan."""
    try:
        x = float(text)
    except (TypeError, ValueError):
        return None
    return x if x == x else None


def _lines(batch: pa.RecordBatch) -> bytes:
    return "".join(f"{p}\n" for p in batch.column(0).to_pylist()).encode()


def _rows(text: str, sep: str) -> list[dict[str, str]]:
    return list(csv.DictReader(io.StringIO("\n".join(x for x in text.splitlines() if x.strip() and not x.startswith("#"))), delimiter=sep))


def _fasta(batch: pa.RecordBatch) -> bytes:
    return "".join(f">{h}\n{s}\n" for h, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)).encode()


def _cleavage(text: str) -> dict[str, list]:
    """position, residue, probability, flag, protein, by blanks; a line that begins with p is the header."""
    rows = [r for x in text.splitlines() if x.strip() and not x.startswith("p") for r in [x.split()] if len(r) > 4]
    return {"transcript": [r[4] for r in rows], "pos": [int(r[0]) for r in rows], "p": [_number(r[2]) for r in rows]}


def _ranks(text: str) -> dict[str, list]:
    out = {n: [] for n, _ in _fields(RANKS)}
    rows = _rows(text, "\t")
    found = [(c, *RANK.match(c).groups()) for c in (rows[0] if rows else {}) if c and RANK.match(c)]
    for r in rows:
        for i, (c, allele, tool) in enumerate(found):
            for n, v in zip(out, (r["peptide"], allele, tool, i, _number(r[c])), strict=True):
                out[n].append(v)
    return out


def _tap_input(batch: pa.RecordBatch) -> bytes:
    return b"peptide\n" + _lines(batch)


def _tap(text: str) -> dict[str, list]:
    rows = _rows(text, ",")
    return {"peptide": [r["peptide"] for r in rows], "tap_score": [_number(r["pred_score"]) for r in rows]}


def _cnn_input(batch: pa.RecordBatch) -> bytes:
    return "".join(f"{p},{a}\n" for p, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)).encode()


def _cnn(text: str) -> dict[str, list]:
    rows = [r for r in _rows(text, "\t") if r["peptide"] and r["HLA"] and _number(r["immunogenicity"]) is not None]
    return {"fragment": [r["peptide"].strip() for r in rows], "allele": [r["HLA"].strip() for r in rows], "score": [_number(r["immunogenicity"]) for r in rows]}


def _prime(text: str) -> dict[str, list]:
    rows = _rows(text, "\t")
    return {"peptide": [r["Peptide"] for r in rows], "prime_rank": [_number(r["%Rank_bestAllele"]) for r in rows]}


#: By kind of tool: cleavage sites of (transcript, seq), ranks of (peptide), transport of (peptide), immunogenicity of
#: (fragment, allele), and immunogenicity ranks of (peptide).
FORMATS = {
    "cleavage": Format(CLEAVAGE, _fasta, _cleavage),
    "ranks": Format(RANKS, _lines, _ranks),
    "tap": Format(TAP, _tap_input, _tap),
    "cnn": Format(CNN, _cnn_input, _cnn),
    "prime": Format(PRIME, _lines, _prime),
}
