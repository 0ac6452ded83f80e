"""What a run leaves in shared folders, and how the leftovers of dead runs are found and removed.

Every application has a folder of its own below the scratch root, ``run-<id>``,
with a lease: a small file that a background thread rewrites every few minutes.
Things outside that folder (staged copies below a root that the user names,
schemas of workspaces) are written down beside the lease before they are made,
and crossed out when they are gone or meant to stay.

``sweep`` removes everything of applications whose lease was not renewed for
long. The lease of a live run is young, however long the run takes; a run whose
driver died stops renewing it.
"""

from __future__ import annotations

import re
import threading
import time
import uuid

from pyspark.sql import SparkSession

from tableferry.session import scratch_root
from tableferry.sources.files import delete_path, list_children, write_text

RENEW_SECONDS = 300.0
#: Hours without renewal after which a run counts as dead.
DEAD_HOURS = 2.0
LEASE = "_lease"
NOTES = "_notes"

_holders: dict[str, threading.Event] = {}
_guard = threading.Lock()


def _own_name(spark: SparkSession) -> str:
    return "run-" + re.sub(r"[^A-Za-z0-9_.-]", "_", spark.sparkContext.applicationId)


def run_folder(spark: SparkSession) -> str:
    """This application's folder; the first call takes out its lease."""
    folder = f"{scratch_root(spark)}/{_own_name(spark)}"
    with _guard:
        if folder not in _holders:
            write_text(spark, f"{folder}/{LEASE}", f"{time.time():.0f}")
            _holders[folder] = threading.Event()
            threading.Thread(target=_renew, args=(spark, folder, _holders[folder]), name="lease", daemon=True).start()
    return folder


def _renew(spark: SparkSession, folder: str, stop: threading.Event) -> None:
    while not stop.wait(RENEW_SECONDS):
        try:
            if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
                return
            write_text(spark, f"{folder}/{LEASE}", f"{time.time():.0f}")
        except Exception:  # a renewal that fails is tried again; several in a row end the lease
            continue


def end_lease(spark: SparkSession) -> None:
    """Stop renewing: what this application left may be swept once the lease is old."""
    with _guard:
        holder = _holders.pop(f"{scratch_root(spark)}/{_own_name(spark)}", None)
    if holder:
        holder.set()


def note(spark: SparkSession, kind: str, name: str) -> str:
    """Write down a ``path`` or ``schema`` outside the run's folder before it is made; returns the note to cross out."""
    if kind not in ("path", "schema"):
        raise ValueError(f"cannot sweep a {kind}")
    place = f"{run_folder(spark)}/{NOTES}/{uuid.uuid4().hex}"
    write_text(spark, place, f"{kind} {name}")
    return place


def cross_out(spark: SparkSession, place: str) -> None:
    """Forget a note: the thing is gone, or it is to stay."""
    delete_path(spark, place)


def sweep(spark: SparkSession, hours: float = DEAD_HOURS) -> list[str]:
    """Remove what dead applications left; returns what was removed.

    An application is dead if its lease was not renewed for ``hours``; its own
    is never touched. Noted things go before the notes, so a sweep that dies is
    carried on by the next one. Other folders of the scratch root are left alone.
    """
    root, own = scratch_root(spark), _own_name(spark)
    removed = []
    for name, _ in list_children(spark, root):
        if not name.startswith("run-") or name == own:
            continue
        renewed = dict(list_children(spark, f"{root}/{name}")).get(LEASE)
        if renewed is None or time.time() * 1000 - renewed < hours * 3_600_000:
            continue
        for place, _ in list_children(spark, f"{root}/{name}/{NOTES}"):
            kind, _, thing = spark.read.text(f"{root}/{name}/{NOTES}/{place}", wholetext=True).first().value.partition(" ")
            if kind == "schema":
                spark.sql(f"DROP SCHEMA IF EXISTS `{thing}` CASCADE")
            else:
                delete_path(spark, thing)
            removed.append(thing)
        delete_path(spark, f"{root}/{name}")
        removed.append(f"{root}/{name}")
    return removed
