"""Control plane: locks, versioned commits of table folders, command lines of finders, step events.

These run on the driver around Spark jobs. Paths are local or mounted on the driver.
"""

from __future__ import annotations

import fcntl
import json
import os
import shutil
import tempfile
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path


def replace_atomically(path: Path, data: bytes) -> None:
    """Readers see the old bytes or the new ones, also after a crash."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise
    folder = os.open(path.parent, os.O_RDONLY)
    try:
        os.fsync(folder)
    finally:
        os.close(folder)


@contextmanager
def named_lock(folder: Path, name: str, timeout: float = 0.0) -> Iterator[None]:
    """An exclusive lock: 0 fails at once, less than 0 waits for ever. The file holds the owner's pid."""
    folder.mkdir(parents=True, exist_ok=True)
    deadline = time.monotonic() + timeout
    with open(folder / f"{name}.lock", "a+") as f:
        while True:
            try:
                fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
                break
            except BlockingIOError:
                if 0 <= timeout and time.monotonic() >= deadline:
                    raise TimeoutError(f"lock {name} is held by another process") from None
                time.sleep(0.05)
        f.seek(0)
        f.truncate()
        f.write(str(os.getpid()))
        f.flush()
        try:
            yield
        finally:
            fcntl.flock(f, fcntl.LOCK_UN)


class Versions:
    """A table as numbered folders and a pointer: commits swap the pointer, a failed one leaves it."""

    def __init__(self, root: Path):
        self.root = Path(root)

    @property
    def current(self) -> int | None:
        pointer = self.root / "CURRENT"
        return int(pointer.read_text()) if pointer.exists() else None

    def path(self, version: int | None = None) -> str:
        version = self.current if version is None else version
        if version is None:
            raise FileNotFoundError(f"nothing committed in {self.root}")
        return str(self.root / f"v{version}")

    def pending(self) -> list[int]:
        """Versions written but never committed: leftovers of rounds that failed."""
        there = sorted(int(p.name[1:]) for p in self.root.glob("v*"))
        return [v for v in there if self.current is None or v > self.current]

    def commit(self, write: Callable[[str], None]) -> int:
        if left := self.pending():
            raise RuntimeError(f"unfinished versions {left}; recover first")
        version = (self.current or 0) + 1
        write(str(self.root / f"v{version}"))
        replace_atomically(self.root / "CURRENT", str(version).encode())
        return version

    def recover(self) -> list[int]:
        """Removes what was never committed."""
        left = self.pending()
        for version in left:
            shutil.rmtree(self.root / f"v{version}")
        return left

    def rollback(self, version: int) -> None:
        if not (self.root / f"v{version}").exists():
            raise FileNotFoundError(f"no version {version}")
        replace_atomically(self.root / "CURRENT", str(version).encode())
        for later in [v for v in self.pending() if v > version]:
            shutil.rmtree(self.root / f"v{later}")


def ruleset_stamp(path: Path) -> str:
    """The rules that made the present corpus; none where there is no stamp, refused while unfinished."""
    text = path.read_text().strip() if path.exists() else "none"
    return text.removeprefix("IN-PROGRESS").strip(" :") or "none"


def finder_command(name: str, settings: dict, pointers: dict, python: str = "python") -> list[str]:
    """Fixed arguments, then the pointer's flag and value where the finder rotates."""
    command = [python, settings["script"], *map(str, settings.get("args", []))]
    if settings.get("rotation", True):
        command += [pointers[name]["flag"], str(pointers[name]["next"])]
    return [*command, "--append"]


def run_steps(steps: list[tuple[str, Callable[[], None]]], event: Callable[..., None]) -> None:
    """Runs steps in order, with an event at each start and end; the first failure ends the run."""
    for name, step in steps:
        event("step_started", step=name)
        began = time.monotonic()
        try:
            step()
        except Exception as error:
            event("step_failed", step=name, error=str(error), elapsed_seconds=round(time.monotonic() - began, 3))
            raise
        event("step_completed", step=name, elapsed_seconds=round(time.monotonic() - began, 3))


def run_finders(finders: list[tuple[str, bool, Callable[[], object]]], workers: int = 6) -> tuple[dict[str, object], dict[str, str]]:
    """Runs finders (name, required, function) side by side: results and failures by name.

    A required finder that fails is an error; optional ones are reported.
    """
    results, failures = {}, {}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        running = [(name, required, pool.submit(find)) for name, required, find in finders]
        for name, required, future in running:
            try:
                results[name] = future.result()
            except Exception as error:
                failures[name] = str(error)
                if required:
                    raise RuntimeError(f"required finder {name} failed: {error}") from error
    return results, failures


class PositiveCache:
    """What was found out, kept in a JSON file; that nothing was found is never kept."""

    def __init__(self, path: Path):
        self.path = Path(path)
        self.known: dict[str, str] = json.loads(self.path.read_text()) if self.path.exists() else {}

    def get(self, key: str, find: Callable[[str], str | None]) -> str | None:
        if key not in self.known and (value := find(key)):
            self.known[key] = value
        return self.known.get(key)

    def save(self) -> None:
        replace_atomically(self.path, (json.dumps(self.known, sort_keys=True) + "\n").encode())


class Transient(Exception):
    """A failure that may pass: a timeout, or an answer of the 500s."""


def retried(ask: Callable[[], object], waits: tuple[float, ...] = (2.0, 4.0, 8.0), sleep: Callable[[float], None] = time.sleep) -> object:
    """Asks again after each wait while the failure is one that may pass; the last such failure is raised."""
    for wait in waits:
        try:
            return ask()
        except (Transient, TimeoutError):
            sleep(wait)
    return ask()


def grow(
    run_round: Callable[[], None],
    *,
    seconds: float,
    target_tokens: int = 0,
    tokens: Callable[[], int] = lambda: 0,
    stop_file: Path | None = None,
    least_free: int = 30 << 30,
    free: Callable[[], int] | None = None,
    window: Callable[[], bool] = lambda: True,
    release: Callable[[], None] = lambda: None,
    maintenance_requested: Callable[[], bool] = lambda: False,
    blocked: Callable[[], str | None] = lambda: None,
    pause: float = 90.0,
    now: Callable[[], float] = time.monotonic,
    sleep: Callable[[float], None] = time.sleep,
) -> tuple[int, int, str]:
    """Runs rounds until one of the exits: (rounds, failures, why it ended).

    Exits: the time is up; the corpus holds the target (0: no target), looked at before each round and
    after each that succeeds; the stop file is there (it is removed); less disk is free than least_free;
    the window between rounds can't be had (a failure); maintenance blocks growth. A round that raises
    is a failure and the next one is tried; requested maintenance has the loop wait its turn.
    """
    free = free or (lambda: shutil.disk_usage(stop_file.parent if stop_file else ".").free)
    end, rounds, failures = now() + seconds, 0, 0
    while now() < end:
        if target_tokens and tokens() >= target_tokens:
            return rounds, failures, "target reached"
        if stop_file is not None and stop_file.exists():
            stop_file.unlink()
            return rounds, failures, "stop file"
        if free() < least_free:
            return rounds, failures, "low disk"
        if not window():
            return rounds, failures + 1, "no window"
        try:
            if not maintenance_requested():
                if reason := blocked():
                    return rounds, failures, f"blocked: {reason}"
                rounds += 1
                try:
                    run_round()
                except Exception:
                    failures += 1
                else:
                    if target_tokens and tokens() >= target_tokens:
                        return rounds, failures, "target reached"
        finally:
            release()
        sleep(pause)
    return rounds, failures, "time is up"
