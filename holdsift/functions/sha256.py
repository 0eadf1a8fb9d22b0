"""SHA-256 whose state can be handed on: OpenSSL's ``SHA256_*`` functions, as Python's hashlib keeps its state to itself."""

from __future__ import annotations

import ctypes
import functools

#: ``SHA256_CTX``: eight state words, two of length, sixteen of the block begun, two numbers; plain data.
STATE = 28 * 4


@functools.cache
def _library():
    import _hashlib

    lib = ctypes.CDLL(_hashlib.__file__)  # symbols are looked up in the libcrypto it is linked to as well
    lib.SHA256_Init.argtypes = [ctypes.c_void_p]
    lib.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
    lib.SHA256_Final.argtypes = [ctypes.c_char_p, ctypes.c_void_p]
    return lib


def available() -> bool:
    try:
        _library()
    except (ImportError, OSError, AttributeError):
        return False
    return True


class Sha256:
    """Like ``hashlib.sha256()``, begun anew or from the ``state`` of another."""

    def __init__(self, state: bytes | None = None):
        self._ctx = ctypes.create_string_buffer(state or b"", STATE)
        if state is None:
            _library().SHA256_Init(self._ctx)

    def update(self, data: bytes) -> None:
        _library().SHA256_Update(self._ctx, data, len(data))

    @property
    def state(self) -> bytes:
        return self._ctx.raw

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        _library().SHA256_Final(out, ctypes.create_string_buffer(self._ctx.raw, STATE))
        return out.raw.hex()
