"""Codec, sample rate, channels and length of encoded audio, from its headers: WAV, FLAC, OGG, MP3, MP4.

Each reader takes a whole file's bytes and returns a dict, or None for what isn't of its
kind.  Samples are decoded by plug-ins (``DECODERS``), as decoders aren't part of this package.
"""

from __future__ import annotations

from collections.abc import Callable


def _info(codec: str, rate: int, channels: int, frames: float) -> dict | None:
    return {"codec": codec, "sample_rate": rate, "channels": channels, "duration_sec": frames / rate} if rate > 0 else None


def wav(data: bytes) -> dict | None:
    """The format and data chunks, wherever they are."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return None
    at, form = 12, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if name == b"fmt " and size >= 16:
            number = lambda a, n: int.from_bytes(data[at + 8 + a : at + 8 + a + n], "little")  # noqa: B023, E731
            form = number(2, 2), number(4, 4), number(12, 2), number(14, 2)
        elif name == b"data" and form and form[2]:
            channels, rate, block, bits = form
            return _info(f"pcm_s{bits}le", rate, channels, min(size, len(data) - at - 8) // block)
        at += 8 + size + size % 2
    return None


def flac(data: bytes) -> dict | None:
    """The stream information, which is the first block: 20 bits of rate, 3 of channels, 36 of samples."""
    if data[:4] != b"fLaC" or len(data) < 26 or data[4] & 0x7F:
        return None
    packed = int.from_bytes(data[18:26], "big")
    return _info("flac", packed >> 44, (packed >> 41 & 7) + 1, packed & (1 << 36) - 1)


def ogg(data: bytes) -> dict | None:
    """The first packet tells the codec, the last page the position of its end; Opus counts at 48 kHz from a pre-skip."""
    if data[:4] != b"OggS" or len(data) < 47:
        return None
    packet = data[27 + data[26] :]
    last = data.rfind(b"OggS")
    end = int.from_bytes(data[last + 6 : last + 14], "little", signed=True)
    if packet[:7] == b"\x01vorbis":
        return _info("vorbis", int.from_bytes(packet[12:16], "little"), packet[11], max(end, 0))
    if packet[:8] == b"OpusHead":
        found = _info("opus", 48_000, packet[9], max(end - int.from_bytes(packet[10:12], "little"), 0))
        return found
    if packet[:5] == b"\x7fFLAC":
        return flac(packet[9:]) | {"codec": "flac"} if flac(packet[9:]) else None
    return None


# Fixed values of MPEG audio layer III: kilobits a second by index, for versions 1 and 2; rates of version 1.
KILOBITS = {1: (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320), 2: (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160)}
MP3_RATES = (44_100, 48_000, 32_000)


def _mp3_frame(data: bytes, at: int) -> tuple | None:
    """(rate, channels, samples, bytes, version) of the frame at a place."""
    head = data[at : at + 4]
    if len(head) < 4 or head[0] != 0xFF or head[1] & 0xE6 != 0xE2:  # layer III
        return None
    version = {3: 1, 2: 2, 0: 2.5}.get(head[1] >> 3 & 3)
    bits, rate = head[2] >> 4, head[2] >> 2 & 3
    if version is None or not 0 < bits < 15 or rate == 3:
        return None
    hertz = MP3_RATES[rate] // {1: 1, 2: 2, 2.5: 4}[version]
    samples = 1152 if version == 1 else 576
    size = samples // 8 * KILOBITS[1 if version == 1 else 2][bits] * 1000 // hertz + (head[2] >> 1 & 1)
    return hertz, 1 if head[3] >> 6 == 3 else 2, samples, size, version


def mp3(data: bytes) -> dict | None:
    """The count of frames from the first frame's table if it has one, else by walking over the frames."""
    at = 0
    while data[at : at + 3] == b"ID3" and len(data) >= at + 10:
        size = 0
        for b in data[at + 6 : at + 10]:
            size = size << 7 | b & 0x7F
        at += 10 + size
    first = _mp3_frame(data, at)
    if not first or not _mp3_frame(data, at + first[3]) and len(data) > at + first[3] + 128:
        return None
    rate, channels, samples, _, version = first
    side = at + 4 + ({1: 17, 2: 32} if version == 1 else {1: 9, 2: 17})[channels]
    if data[side : side + 4] in (b"Xing", b"Info") and data[side + 7] & 1:
        return _info("mp3", rate, channels, int.from_bytes(data[side + 8 : side + 12], "big") * samples)
    frames = 0
    while frame := _mp3_frame(data, at):
        frames, at = frames + 1, at + frame[3]
    return _info("mp3", rate, channels, frames * samples)


def mp4(data: bytes) -> dict | None:
    """The movie header's length and the sound description's rate and channels."""
    if data[4:8] != b"ftyp":
        return None
    head, sound = data.find(b"mvhd"), data.find(b"mp4a")
    if head < 0 or sound < 0:
        return None
    wide = data[head + 4] == 1
    number = lambda a, n: int.from_bytes(data[a : a + n], "big")
    scale, length = (number(head + 24, 4), number(head + 28, 8)) if wide else (number(head + 16, 4), number(head + 20, 4))
    rate = number(sound + 28, 2)
    return {"codec": "aac", "sample_rate": rate, "channels": number(sound + 20, 2), "duration_sec": length / scale} if scale and rate else None


READERS: tuple[Callable[[bytes], dict | None], ...] = (wav, flac, ogg, mp3, mp4)


def probe(data: bytes) -> dict | None:
    """By what the bytes are, not by their name; None for anything that no reader knows or that is broken."""
    for reader in READERS:
        try:
            if found := reader(data):
                return found
        except (IndexError, ValueError, ZeroDivisionError):
            return None
    return None


#: codec: a function from a file's bytes and a target rate to mono floats; fill in what is installed.
DECODERS: dict[str, Callable] = {}


def decode(data: bytes, rate: int):
    """Mono floats at ``rate``: WAV here, other codecs by ``DECODERS``; None where there is no way."""
    from .signal import wav_samples

    found = probe(data)
    if not found:
        return None
    if found["codec"].startswith("pcm"):
        return wav_samples(data, rate)
    decoder = DECODERS.get(found["codec"])
    return decoder(data, rate) if decoder else None
