"""Small files that put a result into force, on any Hadoop file system.

A result is written to a folder nobody reads yet; a small file that names the
folder makes it valid.  ``put_if_absent`` creates such a file whole or not at
all, and only for one of several writers, so readers see either nothing or a
complete result.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError


def _path(spark, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(uri)


def _file_system(spark, uri: str):
    return _path(spark, uri).getFileSystem(spark._jsc.hadoopConfiguration())


def _write_new(spark, uri: str, text: str) -> None:
    out = _file_system(spark, uri).create(_path(spark, uri), False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _exists_already(error: Py4JJavaError) -> bool:
    return "FileAlreadyExists" in error.java_exception.getClass().getName()


def put_if_absent(spark, uri: str, text: str) -> bool:
    """Creates ``uri`` with ``text`` unless it exists; tells whether this call created it.

    The text is written under another name first and then given its name without
    replacing anything: by a hard link on a local file system, else by
    Hadoop's rename, which is atomic where the file system's is.
    """
    draft = f"{uri}.{uuid.uuid4().hex}.draft"
    fs = _file_system(spark, uri)
    if fs.exists(_path(spark, uri)):
        return False
    _write_new(spark, draft, text)
    if fs.getScheme() == "file":
        source, target = (_path(spark, u).toUri().getPath() for u in (draft, uri))
        try:
            os.link(source, target)
            return True
        except FileExistsError:
            return False
        finally:
            fs.delete(_path(spark, draft), False)
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, uri).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_path(spark, draft), _path(spark, uri), options)
        return True
    except Py4JJavaError as error:
        fs.delete(_path(spark, draft), False)
        if _exists_already(error):
            return False
        raise


def read_text(spark, uri: str) -> str | None:
    """The text of ``uri``; None if there is no such file."""
    fs, path = _file_system(spark, uri), _path(spark, uri)
    try:
        stream = fs.open(path)
    except Py4JJavaError as error:
        if "FileNotFound" in error.java_exception.getClass().getName():
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark, uri: str, text: str) -> None:
    """Writes ``uri`` anew; whatever was there stays readable until the new text is complete."""
    draft = f"{uri}.{uuid.uuid4().hex}.draft"
    fs = _file_system(spark, uri)
    _write_new(spark, draft, text)
    if fs.getScheme() == "file":
        os.replace(*(_path(spark, u).toUri().getPath() for u in (draft, uri)))
        return
    fs.delete(_path(spark, uri), False)
    fs.rename(_path(spark, draft), _path(spark, uri))


def names(spark, uri: str) -> list[str]:
    """Names of what lies in the folder ``uri``, sorted; none if there is no such folder."""
    fs, path = _file_system(spark, uri), _path(spark, uri)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))
