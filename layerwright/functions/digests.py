"""An md5 that can be left unfinished by one task and finished by another."""

from __future__ import annotations

import _hashlib
import ctypes

# sizeof(MD5_CTX) of OpenSSL's md5.h: four words of state, two of length, a block of sixteen and the bytes in it.
STATE_BYTES = 23 * 4


def _library() -> ctypes.CDLL:
    """The OpenSSL that hashlib uses."""
    return ctypes.CDLL(_hashlib.__file__)


def can_resume() -> bool:
    """Whether that library has md5 as functions over a plain state."""
    return all(hasattr(_library(), name) for name in ("MD5_Init", "MD5_Update", "MD5_Final"))


class Md5:
    """As hashlib's md5, but :meth:`state` can be given to another one, also in another process."""

    def __init__(self, state: bytes | None = None):
        self._library = _library()
        self._state = ctypes.create_string_buffer(state, STATE_BYTES) if state else ctypes.create_string_buffer(STATE_BYTES)
        if not state and not self._library.MD5_Init(self._state):
            raise ValueError("this OpenSSL does not allow md5")

    def update(self, data: bytes | memoryview) -> None:
        self._library.MD5_Update(self._state, bytes(data), ctypes.c_size_t(len(data)))

    def state(self) -> bytes:
        return self._state.raw

    def hexdigest(self) -> str:
        out, ended = ctypes.create_string_buffer(16), ctypes.create_string_buffer(self._state.raw, STATE_BYTES)
        self._library.MD5_Final(out, ended)
        return out.raw.hex()
