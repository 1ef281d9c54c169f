"""One run at a time for an output folder of this machine: a lock file with the run's process number."""

from __future__ import annotations

import os
from pathlib import Path

LOCK = ".pipeline.lock"


def alive(pid: int) -> bool:
    """True if a process has this number. A process that must not be asked exists."""
    if pid <= 0:
        return False
    if os.name == "nt":
        return _alive_on_windows(pid)
    try:
        os.kill(pid, 0)
    except PermissionError:
        return True
    except OSError:
        return False
    return True


def _alive_on_windows(pid: int) -> bool:
    """Signals would end the process there, so its handle is asked for its exit code."""
    import ctypes

    kernel = ctypes.windll.kernel32
    handle = kernel.OpenProcess(0x1000, False, pid)
    if not handle:
        return kernel.GetLastError() == 5  # access denied
    code = ctypes.c_ulong()
    try:
        return not kernel.GetExitCodeProcess(handle, ctypes.byref(code)) or code.value == 259
    finally:
        kernel.CloseHandle(handle)


def acquire(folder: str) -> str | None:
    """None once the folder is locked by this process, else why it is not. The lock of a process that has ended is taken."""
    path = Path(folder) / LOCK
    try:
        path.parent.mkdir(parents=True, exist_ok=True)
        for _ in range(2):
            try:
                with path.open("x") as f:
                    f.write(str(os.getpid()))
                return None
            except FileExistsError:
                owner = path.read_text().strip()
                if owner and alive(int(owner)):
                    return f"{path} is held by process {owner}"
                path.unlink(missing_ok=True)
        return f"{path} was taken meanwhile"
    except (OSError, ValueError) as error:
        return f"{path} cannot be used: {error}"


def release(folder: str) -> None:
    """Give the lock back if this process has it."""
    path = Path(folder) / LOCK
    try:
        if path.read_text().strip() == str(os.getpid()):
            path.unlink(missing_ok=True)
    except OSError:
        pass
