"""One writer at a time: a claim on a table's path, held from staging to the switch.

A claim is one small file that is created only if it is not there. It says who has it and since when. A job that ends, in
whatever way, gives it back; one that is killed leaves it behind, and after a while another job may take it over. The one that
it was taken from finds that out before it switches the table.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tierlake.functions.storage import plain_path, read_text, remove_folder, rename, write_text
from tierlake.operators.tables import PublishError

CLAIM_FILE = "_tierlake_claim.json"
#: How long a job may take: an older claim may be taken over.
SETTING, HOURS = "spark.tierlake.claim.hours", "24"


@contextmanager
def claimed(spark: SparkSession, name: str, path: str) -> Iterator[Callable[[], None]]:
    """Hold the claim on `path` for a write to table `name`; what is given fails if somebody has taken it over.

    The file is created by the file system's create-if-absent, which HDFS, local folders and object stores with conditional
    writes do atomically. `spark.tierlake.claim.hours` (24) is the age from which a claim counts as left behind.
    """
    file, own = f"{path.rstrip('/')}/{CLAIM_FILE}", str(uuid.uuid4())
    text = json.dumps({"claim": own, "table": name, "application": spark.sparkContext.applicationId, "since": _now().isoformat()})
    if not _create(spark, file, text):
        _take_over(spark, name, file, text)

    def check() -> None:
        if _owner(read_text(spark, file)) != own:
            raise PublishError(f"another job has taken over the claim on {path}, so {name} stays as it is")

    try:
        yield check
    finally:
        if _owner(read_text(spark, file)) == own:
            remove_folder(spark, file)


def _take_over(spark: SparkSession, name: str, file: str, text: str) -> None:
    """Replace a claim that is too old; any other one is an error."""
    held = read_text(spark, file)
    busy = PublishError(f"{name} is being written by another job, whose claim is {file}: {held}")
    if held is None or not _left_behind(spark, held):
        raise busy
    aside = f"{file.removesuffix('.json')}_{uuid.uuid4().hex}.json"
    if not rename(spark, file, aside):  # of several that try one gets it
        raise busy
    if read_text(spark, aside) != held:  # somebody was faster, and this is their new claim
        rename(spark, aside, file)
        raise busy
    remove_folder(spark, aside)
    if not _create(spark, file, text):
        raise busy


def _left_behind(spark: SparkSession, held: str) -> bool:
    hours = float(spark.conf.get(SETTING, HOURS))
    try:
        since = datetime.fromisoformat(json.loads(held)["since"])
    except (ValueError, KeyError, TypeError):
        return False  # half written, so it is new; or not a claim
    return _now() - since > timedelta(hours=hours)


def _owner(text: str | None) -> str | None:
    try:
        return json.loads(text)["claim"] if text else None
    except ValueError:
        return None


def _create(spark: SparkSession, file: str, text: str) -> bool:
    """Whether the file was not there and now is."""
    place = urlparse(plain_path(spark, file))
    if place.scheme == "file":  # Hadoop's local file system looks first and creates afterwards
        local = unquote(place.path)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        write_text(spark, file, text, overwrite=False)
    except Py4JJavaError as failed:
        if "FileAlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    return True


def _now() -> datetime:
    return datetime.now(timezone.utc)
