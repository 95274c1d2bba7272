"""ZIP archives with one CSV in them, read as a stream inside tasks."""

from __future__ import annotations

import codecs
import io
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import csv as pacsv
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from countyloom.sources.dimensions import inline_table

# Hadoop names of stores that the reader knows by another name.
STORES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}
BLOCK = 4 << 20


class _Utf8(io.RawIOBase):
    """Byte stream with undecodable bytes replaced, so that one bad byte does not end the read."""

    def __init__(self, raw):
        self._raw = raw
        self._decoder = codecs.getincrementaldecoder("utf-8")("replace")
        self._ready = b""

    def readable(self):
        return True

    def readinto(self, out):
        while not self._ready:
            chunk = self._raw.read(1 << 20)
            self._ready = self._decoder.decode(chunk, final=not chunk).encode("utf-8")
            if not chunk:
                break
        n = min(len(out), len(self._ready))
        out[:n], self._ready = self._ready[:n], self._ready[n:]
        return n


def _file(uri: str):
    """An open file of any store that the archive reader and the session both know."""
    scheme, _, rest = uri.partition(":")
    target = f"{STORES.get(scheme, scheme)}://{rest.lstrip('/') if scheme != 'file' else '/' + rest.lstrip('/')}"
    try:
        system, path = pafs.FileSystem.from_uri(target)
    except (pa.ArrowInvalid, OSError) as error:
        raise ValueError(f"archives cannot be read from {scheme}: ({error}); unpack {uri} or copy it to another store") from error
    return system.open_input_file(path)


@contextmanager
def _csv_in(uri: str):
    """Name of the only CSV member of an archive, and its bytes as UTF-8."""
    with zipfile.ZipFile(_file(uri)) as archive:
        found = {i.filename for i in archive.infolist() if i.filename.lower().endswith(".csv")}
        if len(found) != 1:
            raise ValueError(f"expected exactly one CSV in {uri}, found {len(found)}: {sorted(found)}")
        member = found.pop()
        with archive.open(member) as raw:
            yield member, io.BufferedReader(_Utf8(raw), 1 << 20)


def _reader(stream, **convert) -> pacsv.CSVStreamingReader:
    return pacsv.open_csv(
        stream,
        read_options=pacsv.ReadOptions(block_size=BLOCK),
        parse_options=pacsv.ParseOptions(newlines_in_values=True),
        convert_options=pacsv.ConvertOptions(null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=True, **convert),
    )


def read_archive(spark: SparkSession, uri: str) -> tuple[DataFrame, str]:
    """Rows of an archive's CSV member, all text, and its name. The driver reads the header alone.

    A deflate stream cannot be split, so an archive is the smallest unit of reading; archives are read side by side.
    """
    with _csv_in(uri) as (member, stream):
        columns = _reader(stream).schema.names

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _csv_in(path) as (_, data):
                    yield from _reader(data, column_types=dict.fromkeys(columns, pa.string()))

    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return inline_table(spark, ("path",), [(uri,)]).repartition(1).mapInArrow(rows, schema), member
