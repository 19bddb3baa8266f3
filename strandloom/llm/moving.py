"""Spelling along a document: weights and refinement of context mixing move after every bit.

The bits of a document follow one another, so there is nothing to compute side by side but documents, for which numpy takes
a hundred calls a bit. The loop is therefore a Java function of a few binary columns, compiled by Janino, the compiler that
Spark has for the code it generates, and sent to the executors as a jar.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import zstandard
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Parts of 1 to which inputs are rounded, to fit in a byte; the constant input.
PARTS, CONSTANT = 8, 0.3
#: How far weights and refinement move along the gradient and towards a bit; what the two models' shares are drawn to a half by.
RATE_W, RATE_C, SHARE = 0.005, 0.02, 0.02
NAME = "strandloom_spelt"
#: Applications that have the function.
_known: set[str] = set()

SOURCE = r"""
import java.nio.ByteBuffer;
import java.nio.ByteOrder;

public class StrandloomSpelt implements org.apache.spark.sql.api.java.UDF10 {
    private static byte[] unpacked(Object a) {
        byte[] packed = (byte[]) a;
        return com.github.luben.zstd.Zstd.decompress(packed, (int) com.github.luben.zstd.Zstd.decompressedSize(packed));
    }

    private static ByteBuffer buffer(Object a) {
        return ByteBuffer.wrap((byte[]) a).order(ByteOrder.LITTLE_ENDIAN);
    }

    private static int[] ints(Object a) {
        int[] out = new int[((byte[]) a).length / 4];
        buffer(a).asIntBuffer().get(out);
        return out;
    }

    private static double[] doubles(Object a) {
        double[] out = new double[((byte[]) a).length / 8];
        buffer(a).asDoubleBuffer().get(out);
        return out;
    }

    /* log10 of the chance of the words of each text that are spelt. sizes: their numbers; tokens: of each the word, its place in the
       text, and how often it came before; known: ln of the other model's chance. first: where a word's edges begin in edge; bytes,
       x, gate: of each edge the byte, and of its bits five inputs and the gate. settings: the number of weights, cells of a partial byte,
       alpha, how far things move, parts, the constant input. start: weights and refinement as learnt. */
    public Object call(Object sizes0, Object tokens0, Object known0, Object first0, Object edge0, Object bytes0, Object x0, Object gate0, Object settings0, Object start0) {
        int[] sizes = ints(unpacked(sizes0)), tokens = ints(unpacked(tokens0)), first = ints(unpacked(first0)), edge = ints(unpacked(edge0));
        double[] known = doubles(unpacked(known0)), settings = doubles(settings0), start = doubles(start0);
        byte[] bytes = unpacked(bytes0), x = unpacked(x0), gate = unpacked(gate0);
        int steps = (int) settings[1];
        double alpha = settings[2], rateW = settings[3], rateC = settings[4], share = settings[5], part = 1 / settings[6], constant = settings[7];
        double[] w = new double[(int) settings[0]], r = new double[start.length - w.length], out = new double[sizes.length];
        int at = 0;
        for (int t = 0; t < sizes.length; t++) {
            System.arraycopy(start, 0, w, 0, w.length);
            System.arraycopy(start, w.length, r, 0, r.length);
            double a = 0.5, sum = 0;
            for (int end = at + sizes[t]; at < end; at++) {
                int word = tokens[3 * at];
                double m = 0;
                for (int k = first[word]; k < first[word + 1]; k++) {
                    m += edge(w, r, bytes, x, gate, edge[k], steps, rateW, rateC, part, constant);
                }
                double d = Math.min(Math.max(known[at] - m, -700.0), 700.0), other = (1 - a) * Math.exp(d), s = m + Math.log(a + other);
                a = share / 2 + (1 - share) * a / (a + other);
                int came = tokens[3 * at + 2];
                sum += (came == 0 ? s + Math.log(alpha) : Math.log(alpha * Math.exp(s) + came)) - Math.log(alpha + tokens[3 * at + 1]);
            }
            out[t] = sum / Math.log(10.0);
        }
        return out;
    }

    /* ln of a byte's chance, after which weights and refinement have moved. */
    private static double edge(double[] w, double[] r, byte[] bytes, byte[] x, byte[] gate, int e, int steps, double rateW, double rateC, double part, double constant) {
        int partial = 1, of = bytes[e], half = steps / 2;
        double product = 1;
        for (int j = 0; j < 8; j++) {
            int bit = of >> (7 - j) & 1, own = (gate[8 * e + j] & 255) * 6, from = (8 * e + j) * 5;
            double a = x[from] * part, b = x[from + 1] * part, c = x[from + 2] * part, d = x[from + 3] * part, f = x[from + 4] * part;
            double mixed = w[own] * a + w[own + 1] * b + w[own + 2] * c + w[own + 3] * d + w[own + 4] * f + w[own + 5] * constant;
            double p = 1 / (1 + Math.exp(mixed > 20 ? -20 : mixed < -20 ? 20 : -mixed));
            int cell = (int) Math.rint(mixed > 20 ? 40 : mixed < -20 ? -40 : mixed * 2) + half;
            cell = partial * steps + (cell < 0 ? 0 : cell >= steps ? steps - 1 : cell);
            double q = (p + r[cell]) * 0.5, error = rateW * (bit - p);
            q = q < 1e-6 ? 1e-6 : q > 1 - 1e-6 ? 1 - 1e-6 : q;
            product *= bit == 1 ? q : 1 - q;
            w[own] += error * a;
            w[own + 1] += error * b;
            w[own + 2] += error * c;
            w[own + 3] += error * d;
            w[own + 4] += error * f;
            w[own + 5] += error * constant;
            r[cell] += rateC * (bit - r[cell]);
            partial = 2 * partial + bit;
        }
        return Math.log(product);
    }
}
"""

#: The columns that spelt reads.
COLUMNS = ("sizes", "tokens", "known", "first", "edge", "bytes", "x", "gate")


def _register(spark: SparkSession) -> None:
    """The function under NAME, and its class on the executors; once for each application."""
    app = spark.sparkContext.applicationId
    compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
    compiler.cook(SOURCE)
    if app not in _known:
        jar = os.path.join(tempfile.mkdtemp(prefix="strandloom-code-"), "strandloom_spelt.jar")
        with zipfile.ZipFile(jar, "w") as z:
            for name, code in compiler.getBytecodes().items():
                z.writestr(f"{name.replace('.', '/')}.class", bytes(code))
        spark.sparkContext._jsc.addJar(jar)
        _known.add(app)
    made = compiler.getClassLoader().loadClass("StrandloomSpelt").getDeclaredConstructors()[0].newInstance(None)
    spark._jsparkSession.udf().register(NAME, made, spark._jvm.org.apache.spark.sql.types.DataType.fromDDL("array<double>"))


def spelt(spark: SparkSession, weights: np.ndarray, refine: np.ndarray, alpha: float) -> Column:
    """For each text of a row of COLUMNS log10 of its spelt words: two models' chances, mixed by what they foretold before, and an urn.

    One model spells bit by bit, from weights and refinement as learnt, which move along a text; the other's chances are known.
    """
    _register(spark)
    settings = np.array([weights.size, refine.shape[1], alpha, RATE_W, RATE_C, SHARE, PARTS, CONSTANT])
    start = np.concatenate([weights.ravel(), refine.ravel()])
    return F.call_udf(NAME, *COLUMNS, *(F.lit(bytearray(x.astype("<f8").tobytes())) for x in (settings, start)))


def _numbered(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of n numbers are in x, and x by their places among these."""
    here = np.zeros(n, bool)
    here[x] = True
    return np.flatnonzero(here), (np.cumsum(here) - 1)[x]


class Spelling:
    """A block's words: their edges, and of each edge's bits the inputs and gates."""

    def __init__(self, first: np.ndarray, edge: np.ndarray, byte: np.ndarray, x: np.ndarray, gate: np.ndarray) -> None:
        """first: where a word's edges begin in edge; x: edge by bit by input but the constant one, in PARTS; gate: edge by bit."""
        self.first, self.edge, self.byte, self.x, self.gate = first, edge, byte, x, gate

    def columns(self, ids: np.ndarray, sizes: np.ndarray, spelt: np.ndarray, known: np.ndarray, came: np.ndarray) -> dict[str, bytes]:
        """COLUMNS of some texts, compressed, one after the other: words by number, which are spelt, log10 of their known chances, how often each came before."""
        text, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        words, word = _numbered(ids[spelt], len(self.first) - 1)
        of = self.first[words + 1] - self.first[words]
        first = np.concatenate([[0], np.cumsum(of)])
        edges, edge = _numbered(self.edge[np.repeat(self.first[words] - first[:-1], of) + np.arange(int(first[-1]))], len(self.byte))
        out = [np.bincount(text[spelt], minlength=len(sizes)), np.stack([word, place[spelt], came[spelt]], 1), first, edge]
        sizes, tokens, first, edge = (x.astype("<i4").tobytes() for x in out)
        known = (known[spelt] * np.log(10)).astype("<f8").tobytes()
        cells = sizes, tokens, known, first, edge, *(x[edges].tobytes() for x in (self.byte, self.x, self.gate))
        return dict(zip(COLUMNS, map(zstandard.ZstdCompressor(level=1).compress, cells), strict=True))
