"""Exclusive jobs: a claim on the lake that one run holds at a time.

A job's claim is a chain of manifests (``sources/manifest.py``). Whoever creates the next manifest
holds the claim until it releases it or its time is over; a run that died is so replaced. A thread of
the holder renews the claim while its process lives, however long one table takes; a holder that checks its
claim learns if another run has taken it. What a run must tell the next one (the cycle of an unfinished
refresh) is part of the claim's state.
"""

from __future__ import annotations

import datetime as dt
import os
import socket
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tallyward.sources.manifest import Chain
from tallyward.sources.tables import Lake, micros, utc_now

#: How long a claim holds when its process has died.
LIFETIME = dt.timedelta(hours=1)
#: Renewals in a lifetime.
BEATS = 6


class ClaimHeld(RuntimeError):
    """Another run holds the claim."""


class ClaimLost(RuntimeError):
    """The claim's time was over, and another run has taken it."""


class Claim:
    """``with Claim(spark, lake, "refresh") as claim: ...``"""

    def __init__(self, spark: SparkSession, lake: Lake, job: str, lifetime: dt.timedelta = LIFETIME, clock: Callable[[], dt.datetime] = utc_now):
        self.job, self.lifetime, self.clock = job, lifetime, clock
        self.chain = Chain(spark, lake.path("control", f"claims/{job}"))
        self.owner = f"{socket.gethostname()}-{os.getpid()}-{uuid.uuid4().hex[:8]}"
        self.number = 0
        self.facts: dict = {}
        self._lock = threading.RLock()  # of the holder and its renewing thread
        self._ended = threading.Event()

    def _until(self) -> int:
        return micros(self.clock() + self.lifetime)

    def take(self) -> Claim:
        while True:
            number, state = self.chain.latest()
            if state.get("owner") and state["until"] > micros(self.clock()):
                until = dt.datetime.fromtimestamp(state["until"] / 1e6, dt.timezone.utc)
                raise ClaimHeld(f"{self.job} is running: {state['owner']} holds its claim until {until:%Y-%m-%d %H:%M:%S} UTC")
            if self.chain.commit(number + 1, {"owner": self.owner, "until": self._until(), "facts": state.get("facts", {})}):
                self.number, self.facts = number + 1, state.get("facts", {})
                threading.Thread(target=self._renew, daemon=True, name=f"claim-{self.job}").start()
                return self

    def _renew(self) -> None:
        while not self._ended.wait(self.lifetime.total_seconds() / BEATS):
            try:
                self.check()
            except ClaimLost:
                return  # the holder's own next check tells it
            except Exception:  # the file system or the session is away: until the next beat
                continue

    def _replace(self, state: dict) -> None:
        if not self.chain.commit(self.number + 1, state):
            raise ClaimLost(f"{self.job}: another run has taken the claim of {self.owner}")
        self.number += 1

    def check(self) -> None:
        """Go on only while the claim is held; renewed when a part of its time is over."""
        with self._lock:
            number, state = self.chain.latest()
            if number != self.number:
                raise ClaimLost(f"{self.job}: {state.get('owner') or 'another run'} has taken the claim of {self.owner}")
            if state["until"] - micros(self.clock()) < (self.lifetime - self.lifetime / (2 * BEATS)) / dt.timedelta(microseconds=1):
                self._replace({**state, "until": self._until()})

    def note(self, **facts) -> None:
        """Keep facts for the runs that follow."""
        with self._lock:
            self.facts = {**self.facts, **facts}
            self._replace({"owner": self.owner, "until": self._until(), "facts": self.facts})

    def release(self) -> None:
        self._ended.set()
        with self._lock:
            if self.chain.commit(self.number + 1, {"owner": None, "until": 0, "facts": self.facts}):
                self.number += 1  # else another run has it

    def __enter__(self) -> Claim:
        return self.take()

    def __exit__(self, *_) -> None:
        self.release()
