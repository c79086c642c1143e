"""Moving finished outputs into place through Hadoop's file system API."""

from __future__ import annotations

import uuid

from pyspark.errors import IllegalArgumentException, UnsupportedOperationException
from pyspark.sql import DataFrameWriter, SparkSession


def staging_for(target: str) -> str:
    """A fresh folder beside ``target`` (same file system, so the final
    rename is a metadata operation)."""
    return f"{target.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    hpath, fs = _fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def found(spark: SparkSession, path: str) -> bool:
    hpath, fs = _fs(spark, path)
    return bool(fs.exists(hpath))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    hpath, fs = _fs(spark, pattern)
    return sorted(st.getPath().toString() for st in (fs.globStatus(hpath) or []) if st.isDirectory())


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a folder."""
    hpath, fs = _fs(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    hpath, fs = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    hpath, fs = _fs(spark, path)
    stream = fs.create(hpath, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name that must be free; False if it is taken."""
    hsource, fs = _fs(spark, source)
    htarget, _ = _fs(spark, target)
    return not fs.exists(htarget) and bool(fs.rename(hsource, htarget))


def move_over(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one."""
    hsource, fs = _fs(spark, source)
    htarget, _ = _fs(spark, target)
    if fs.exists(htarget):
        fs.delete(htarget, True)
    if not fs.exists(htarget.getParent()):
        fs.mkdirs(htarget.getParent())
    if not fs.rename(hsource, htarget):
        raise RuntimeError(f"could not move {source} to {target}")


def single_part_to_file(spark: SparkSession, out_dir: str, target: str) -> None:
    """Move the one data file Spark wrote into ``out_dir`` to ``target``
    (replacing it) and remove ``out_dir``."""
    hdir, fs = _fs(spark, out_dir)
    parts = [st.getPath() for st in fs.listStatus(hdir)
             if st.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {out_dir}, found {len(parts)}")
    htarget, tfs = _fs(spark, target)
    if tfs.exists(htarget):
        tfs.delete(htarget, True)
    parent = htarget.getParent()
    if parent is not None and not tfs.exists(parent):
        tfs.mkdirs(parent)
    if not fs.rename(parts[0], htarget):
        raise RuntimeError(f"could not move {parts[0]} to {target}")
    fs.delete(hdir, True)
    _drop_checksum(spark, htarget)


def concatenate_parts(spark: SparkSession, out_dir: str, target: str, first: str = "") -> None:
    """``first`` and then the part files of ``out_dir``, in name order, as one
    file at ``target`` (replacing it); ``out_dir`` is removed. The parts are
    joined by the file system where it can do that (HDFS), else copied through
    a fixed buffer; either way beside ``target``, which is replaced by a rename."""
    hdir, fs = _fs(spark, out_dir)
    parts = sorted((st.getPath() for st in fs.listStatus(hdir)
                    if st.getPath().getName().startswith("part-") and st.getLen() > 0), key=lambda p: p.getName())
    draft = staging_for(target)
    hdraft, _ = _fs(spark, draft)
    htarget, tfs = _fs(spark, target)
    if htarget.getParent() is not None and not tfs.exists(htarget.getParent()):
        tfs.mkdirs(htarget.getParent())
    write_text(spark, draft, first)
    jvm = spark.sparkContext._jvm
    if parts and not _joined(spark, fs, hdraft, parts):
        out = fs.create(hdraft, True)
        try:
            out.write(bytearray(first.encode("utf-8")))
            for part in parts:
                source = fs.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                finally:
                    source.close()
        finally:
            out.close()
    if tfs.exists(htarget):
        tfs.delete(htarget, True)
    if not fs.rename(hdraft, htarget):
        raise RuntimeError(f"could not move {draft} to {target}")
    fs.delete(hdir, True)
    _drop_checksum(spark, htarget)


def _joined(spark: SparkSession, fs, hfirst, parts) -> bool:
    """The parts appended to the first file by the file system, if it can."""
    array = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, part in enumerate(parts):
        array[i] = part
    try:
        fs.concat(hfirst, array)
        return True
    except (UnsupportedOperationException, IllegalArgumentException):  # not HDFS, or files that it cannot join
        return False


def _drop_checksum(spark: SparkSession, hpath) -> None:
    """The local file system keeps a hidden '.name.crc' beside each file and
    moves it on rename; a published single file is left without it."""
    if hpath.toUri().getScheme() not in (None, "file"):
        return
    jvm = spark.sparkContext._jvm
    crc = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), "." + hpath.getName() + ".crc")
    fs = crc.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(crc):
        fs.delete(crc, False)


def replace_dir(spark: SparkSession, staged: str, target: str) -> None:
    """Swap a finished folder into place: the old one is renamed away, the new
    one comes in, then the old one is deleted. If the new one cannot be moved
    the old one is moved back."""
    hstaged, fs = _fs(spark, staged)
    htarget, _ = _fs(spark, target)
    old = None
    if fs.exists(htarget):
        old, _ = _fs(spark, staging_for(target))
        if not fs.rename(htarget, old):
            raise RuntimeError(f"could not move {target} aside")
    parent = htarget.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(hstaged, htarget):
        if old is not None:
            fs.rename(old, htarget)
        raise RuntimeError(f"could not move {staged} to {target}")
    if old is not None:
        fs.delete(old, True)
    spark.catalog.refreshByPath(target)


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy one file unchanged: beside ``target`` first, then renamed."""
    hsource, sfs = _fs(spark, source)
    hstaged, tfs = _fs(spark, staging_for(target))
    htarget, _ = _fs(spark, target)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm = spark.sparkContext._jvm
    if htarget.getParent() is not None and not tfs.exists(htarget.getParent()):
        tfs.mkdirs(htarget.getParent())
    jvm.org.apache.hadoop.fs.FileUtil.copy(sfs, hsource, tfs, hstaged, False, conf)
    if tfs.exists(htarget):
        tfs.delete(htarget, False)
    if not tfs.rename(hstaged, htarget):
        raise RuntimeError(f"could not move {hstaged} to {target}")
    _drop_checksum(spark, htarget)


def write_then_replace(spark: SparkSession, writer: DataFrameWriter, target: str) -> None:
    """Write Parquet beside ``target`` and swap it in; a failed write leaves
    ``target`` as it was."""
    staged = staging_for(target)
    try:
        writer.parquet(staged)
    except BaseException:
        delete(spark, staged)
        raise
    replace_dir(spark, staged, target)
