"""Runs stages one after another, as a command or a notebook would."""

import time
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Ran:
    stage: str
    seconds: float
    error: str = ""


def run_stages(stages: list[tuple[str, Callable[[], object]]], needs: Callable[[str], list[str]] = lambda stage: [], report: Callable[[Ran], None] = lambda ran: None) -> list[Ran]:
    """What has run, in order. `needs` names what a stage misses, which stops the run before it; so does a stage that fails, or
    returns a number other than 0. Later stages aren't run."""
    done = []
    for name, stage in stages:
        began, missing, error = time.time(), needs(name), ""
        if missing:
            error = f"missing: {', '.join(missing)}"
        else:
            try:
                code = stage()
                error = f"exit code {code}" if isinstance(code, int) and not isinstance(code, bool) and code else ""
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
        done.append(Ran(name, time.time() - began, error))
        report(done[-1])
        if error:
            break
    return done
