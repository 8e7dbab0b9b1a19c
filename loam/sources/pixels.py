"""What images hold: sizes from their headers, without decoding; pixels, hashes and sharpness; crops.

The Pillow library is used where executors have it; without it PNG and BMP files are decoded here.
"""

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def header_size(data: bytes | None) -> tuple[int, int] | None:
    """Width and height by the header of a PNG, JPEG, WebP or BMP file; None for anything else or a cut one."""
    data = data or b""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR":
            return struct.unpack(">II", data[16:24])
        if data[:2] == b"BM":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            kind = data[12:16]
            if kind == b"VP8X":
                return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
            if kind == b"VP8L":
                bits = int.from_bytes(data[21:25], "little")
                return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
            w, h = struct.unpack("<HH", data[26:30])
            return w & 0x3FFF, h & 0x3FFF
        if data[:2] == b"\xff\xd8":
            at = 2
            while data[at] == 0xFF:
                mark = data[at + 1]
                if mark == 0xFF:
                    at += 1
                    continue
                # Start-of-frame segments; the codes left out define tables.
                if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return w, h
                at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    except (struct.error, IndexError):
        pass
    return None


def with_sizes(images: DataFrame, content: str = "content") -> DataFrame:
    """images with width, height and whether the header can't be read; the bytes go no further."""

    @F.pandas_udf("width int, height int")
    def size(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([header_size(d) or (None, None) for d in data], columns=["width", "height"]).astype("Int32")

    out = images.withColumn("_size", size(F.col(content))).drop(content)
    return out.select(*[c for c in out.columns if c != "_size"], "_size.width", "_size.height").withColumn("corrupt", F.col("width").isNull())


def _chunks(data: bytes):
    """Kind and body of a PNG file's chunks; fails on a cut chunk or a wrong checksum."""
    at, kind = 8, b""
    while kind != b"IEND":
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body, crc = data[at + 8 : at + 8 + size], data[at + 8 + size : at + 12 + size]
        if len(body) != size or crc != struct.pack(">I", zlib.crc32(kind + body)):
            raise ValueError("cut or damaged chunk")
        yield kind, body
        at += 12 + size


def _png(data: bytes) -> np.ndarray:
    """(height, width, samples) of a PNG file of 8 bits a sample that isn't interlaced; palettes are looked up."""
    parts = list(_chunks(data))
    w, h, depth, colour, _, _, laced = struct.unpack(">IIBBBBB", parts[0][1])
    n = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    if depth != 8 or laced:
        raise NotImplementedError("needs the Pillow library")
    raw = np.frombuffer(zlib.decompress(b"".join(b for k, b in parts if k == b"IDAT")), "u1").reshape(h, 1 + w * n)
    out = np.zeros((h + 1, w + 1, n), "u1")
    for y in range(h):
        kind, line, above = raw[y, 0], raw[y, 1:].reshape(w, n), out[y]
        if kind in (0, 2):
            out[y + 1, 1:] = line + (above[1:] if kind else 0)
        elif kind == 1:
            out[y + 1, 1:] = np.cumsum(line, axis=0, dtype="u1")
        else:
            own = out[y + 1]
            for x in range(w):
                a, b, c = own[x].astype(int), above[x + 1].astype(int), above[x].astype(int)
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    pa, pb, pc = abs(p - a), abs(p - b), abs(p - c)
                    guess = np.where((pa <= pb) & (pa <= pc), a, np.where(pb <= pc, b, c))
                own[x + 1] = (line[x] + guess) & 255
    out = out[1:, 1:]
    if colour == 3:
        palette = np.frombuffer(next(b for k, b in parts if k == b"PLTE"), "u1").reshape(-1, 3)
        out = palette[out[:, :, 0]]
    return out[:, :, : {2: 1, 4: 3}.get(out.shape[2], out.shape[2])]


def _bmp(data: bytes) -> np.ndarray:
    """(height, width, 3) of a BMP file of 24 or 32 bits without compression."""
    start, (w, h), (_, bits, packed) = struct.unpack("<I", data[10:14])[0], struct.unpack("<ii", data[18:26]), struct.unpack("<HHI", data[26:34])
    if bits not in (24, 32) or packed:
        raise NotImplementedError("needs the Pillow library")
    line = (w * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, "u1", line * abs(h), start).reshape(abs(h), line)[:, : w * bits // 8].reshape(abs(h), w, bits // 8)
    return (rows[::-1] if h > 0 else rows)[:, :, 2::-1]


def decoded(data: bytes) -> np.ndarray:
    """The whole image as (height, width, 1 or 3) samples; fails if it can't be decoded. The Pillow library decodes all kinds;
    without it PNG and BMP files are."""
    try:
        from PIL import Image
    except ImportError:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data)
        if data[:2] == b"BM":
            return _bmp(data)
        raise NotImplementedError("needs the Pillow library") from None
    image = Image.open(io.BytesIO(data))
    image = image.convert("L" if image.mode in ("1", "L", "I;16") else "RGB")
    return np.asarray(image).reshape(image.height, image.width, -1)


def encoded(samples: np.ndarray, quality: int = 95) -> tuple[bytes, str]:
    """A file of the image and its ending: JPEG where the Pillow library is installed, else PNG, which loses nothing."""
    try:
        from PIL import Image
    except ImportError:
        h, w, n = samples.shape
        chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
        lines = np.hstack([np.zeros((h, 1), "u1"), samples.reshape(h, w * n)]).tobytes()
        head = struct.pack(">IIBBBBB", w, h, 8, 0 if n == 1 else 2, 0, 0, 0)
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b""), "png"
    out = io.BytesIO()
    Image.fromarray(samples[:, :, 0] if samples.shape[2] == 1 else samples).convert("RGB").save(out, "JPEG", quality=quality)
    return out.getvalue(), "jpg"


def is_whole(data: bytes | None) -> bool:
    """Whether a file can be decoded to its end. Where nothing here decodes its kind, its structure must reach its end."""
    data = data or b""
    if not header_size(data):
        return False
    try:
        return decoded(data).size > 0
    except NotImplementedError:
        pass
    except Exception:
        return False
    if data[:2] == b"\xff\xd8":
        return b"\xff\xda" in data and data.rstrip(b"\0")[-2:] == b"\xff\xd9"
    if data[:4] == b"RIFF":
        return len(data) >= 8 + int.from_bytes(data[4:8], "little")
    try:
        return any(k == b"IDAT" for k, _ in _chunks(data)) if data[1:4] == b"PNG" else len(data) >= int.from_bytes(data[2:6], "little")
    except (ValueError, struct.error):
        return False


def grey_samples(samples: np.ndarray) -> np.ndarray:
    """(height, width) of luma, rounded as the usual integer weights do."""
    if samples.shape[2] == 1:
        return samples[:, :, 0]
    weights = np.array([19595, 38470, 7471])  # fixed values: 0.299, 0.587 and 0.114 of 2^16
    return ((samples[:, :, :3].astype("i8") @ weights + (1 << 15)) >> 16).astype("u1")


def shrunk(grey: np.ndarray, side: int) -> np.ndarray:
    """side x side means of the areas that each cell covers, edges counted by their share."""

    def weights(n: int) -> np.ndarray:
        edges = np.arange(side + 1) * n / side
        low, high = np.maximum(edges[:-1, None], np.arange(n)), np.minimum(edges[1:, None], np.arange(1, n + 1))
        return np.maximum(high - low, 0) * side / n

    return weights(grey.shape[0]) @ grey.astype(float) @ weights(grey.shape[1]).T


def perceptual_hash(grey: np.ndarray) -> int:
    """64 bits, signed: which of the 8 x 8 lowest frequencies of the image, shrunk to 32 x 32, are above their median."""
    n, k = 32, 8
    waves = np.cos(np.pi * np.outer(np.arange(k), 2 * np.arange(n) + 1) / (2 * n))
    low = (waves @ shrunk(grey, n) @ waves.T).ravel().round(6)
    bits = (low > np.median(low)).astype("u1")
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def measured(images: DataFrame, tiles: int = 4) -> DataFrame:
    """images with width, height, corrupt, h (the perceptual hash), sharpness and tiles, of a whole decoding each; the bytes go
    no further. What can't be decoded is corrupt and has no measures; of what nothing here decodes sizes are known alone."""
    names = [c for c in images.columns if c != "content"]
    schema = images.select(*names).schema.simpleString()[7:-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for data in batch["content"]:
                try:
                    grey = grey_samples(decoded(data or b""))
                    cells = [grey[a:b, c:d] for a, b in _cuts(grey.shape[0], tiles) for c, d in _cuts(grey.shape[1], tiles)]
                    rows.append((grey.shape[1], grey.shape[0], False, perceptual_hash(grey), laplacian_variance(grey), [laplacian_variance(x) for x in cells]))
                except NotImplementedError:
                    size = header_size(data) or (None, None)
                    rows.append((*size, not is_whole(data), None, None, None))
                except Exception:
                    rows.append((None, None, True, None, None, None))
            found = pd.DataFrame(rows, columns=["width", "height", "corrupt", "h", "sharpness", "tiles"]).astype({"width": "Int32", "height": "Int32", "h": "Int64"})
            yield pd.concat([batch[names].reset_index(drop=True), found], axis=1)

    return images.mapInPandas(run, f"{schema.replace(':', ' ')}, width int, height int, corrupt boolean, h long, sharpness double, tiles array<double>")


def _cuts(size: int, n: int) -> list[tuple[int, int]]:
    edges = [round(i * size / n) for i in range(n + 1)]
    return list(zip(edges, edges[1:], strict=False))


def laplacian_variance(grey: np.ndarray) -> float:
    """Of a population, with a border that mirrors about its edge elements; 0 for an empty grid."""
    if not grey.size:
        return 0.0
    g = np.pad(grey.astype(float), [(1, 1) if n > 1 else (0, 0) for n in grey.shape], mode="reflect")
    g = np.pad(g, [(0, 0) if n > 1 else (1, 1) for n in grey.shape], mode="edge")
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var())


def cropped(images: DataFrame, quality: int = 95) -> DataFrame:
    """(path, image_name, content) of images (path, out_name, box, content): the box of each, encoded anew under out_name with
    the ending of what it is encoded as. What can't be decoded is left out; its manifest row says so."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, name, box, data in zip(batch["path"], batch["out_name"], batch["box"], batch["content"], strict=True):
                try:
                    whole = decoded(data)
                except Exception:
                    continue
                body, ending = encoded(np.ascontiguousarray(whole[box["t"] : box["b"], box["l"] : box["r"]]), quality)
                rows.append((path, f"{name.rsplit('.', 1)[0]}.{ending}", body))
            yield pd.DataFrame(rows, columns=["path", "image_name", "content"])

    return images.select("path", "out_name", "box", "content").mapInPandas(run, "path string, image_name string, content binary")


def grey(images: DataFrame, side: int | None = None) -> DataFrame:
    """(path, width, height, pixels): grey values in row order, shrunk to side x side if given; null pixels if the image
    can't be decoded."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, data in zip(batch["path"], batch["content"], strict=True):
                try:
                    image = grey_samples(decoded(data))
                    image = np.floor(shrunk(image, side) + 0.5).astype("u1") if side else image
                    rows.append((path, image.shape[1], image.shape[0], image.ravel().tolist()))
                except Exception:
                    rows.append((path, None, None, None))
            yield pd.DataFrame(rows, columns=["path", "width", "height", "pixels"])

    return images.select("path", "content").mapInPandas(run, "path string, width int, height int, pixels array<int>")
