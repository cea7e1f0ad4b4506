"""Scorer factory for a pre-trained network saved as ONNX (the plug-in point of ``featurize``).

The model file is shipped to every executor with ``addFile``; each task opens one
``onnxruntime`` session and scores whole Arrow batches. ``onnxruntime`` is imported
inside the task, so the engine itself does not depend on it.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import SparkSession

from .scoring import BatchFn, check_model_size


def _file_bytes(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen()


def onnx_scorer(spark: SparkSession, model_path: str, *, input_shape: tuple[int, ...] | None = None,
                channels_first: bool = False, output_name: str | None = None,
                threads: int = 1) -> Callable[[], BatchFn]:
    """Factory for ``featurize``: rows (n × d) are reshaped to ``(n, *input_shape)``, run
    through the graph, and the chosen output (default: the first) is flattened per row.
    Image rows are height × width × channels; ``channels_first`` transposes them to the
    NCHW order most pre-trained networks take (``input_shape`` stays ``(h, w, c)``)."""
    check_model_size(spark, _file_bytes(spark, model_path))
    spark.sparkContext.addFile(model_path)
    name = os.path.basename(model_path)

    def factory() -> BatchFn:
        import onnxruntime as ort
        from pyspark import SparkFiles

        opts = ort.SessionOptions()
        opts.intra_op_num_threads = threads
        sess = ort.InferenceSession(SparkFiles.get(name), opts, providers=["CPUExecutionProvider"])
        inp = sess.get_inputs()[0].name
        out = output_name or sess.get_outputs()[0].name

        def run(x: np.ndarray) -> np.ndarray:
            shaped = x.astype(np.float32).reshape((len(x),) + tuple(input_shape)) if input_shape else \
                x.astype(np.float32)
            if channels_first and shaped.ndim == 4:
                shaped = np.ascontiguousarray(shaped.transpose(0, 3, 1, 2))
            y = sess.run([out], {inp: shaped})[0]
            return np.asarray(y, dtype=np.float64).reshape(len(x), -1)

        return run

    return factory
