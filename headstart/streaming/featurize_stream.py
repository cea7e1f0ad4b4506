"""Incremental featurization with Structured Streaming.

The featurize plan over a streaming ``image`` source with an exactly-once Parquet file
sink: each trigger featurizes only the images that arrived since the last one, and the
checkpoint makes a failed run resume where it stopped instead of starting over (the
reference's featurization runs for hours and restarts from scratch on failure).
The default ``available_now`` trigger processes everything present, then stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..model import Model
from ..operators.scoring import BatchFn
from ..plans.programs import image_features, image_scorer
from ..sources.files import IMAGE_CHANNELS, IMAGE_HEIGHT, IMAGE_WIDTH, stream_images


def featurize_stream(spark: SparkSession, image_root: str, save_path: str, checkpoint: str, *,
                     n_classes: int = 257, model: Model | None = None, output_layer: str | None = None,
                     scorer_factory: Callable[[], BatchFn] | None = None, height: int = IMAGE_HEIGHT,
                     width: int = IMAGE_WIDTH, channels: int = IMAGE_CHANNELS, on_bad: str = "error",
                     max_files_per_trigger: int | None = None, available_now: bool = True,
                     processing_time: str | None = None, layout: str = "float") -> StreamingQuery:
    """Start the stream; the sink is partitioned by ``split`` like the batch writer."""
    if not (image_root and save_path and checkpoint):
        raise ValueError("image_root, save_path and checkpoint are required")
    scorer = image_scorer(spark, model=model, output_layer=output_layer, scorer_factory=scorer_factory,
                          n_in=height * width * channels)
    imgs = stream_images(spark, image_root, on_invalid="drop" if on_bad == "drop" else "error",
                         max_files_per_trigger=max_files_per_trigger)
    feats = image_features(imgs, scorer, n_classes=n_classes, height=height, width=width, channels=channels,
                           on_bad=on_bad, layout=layout)
    w = (feats.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy("split").outputMode("append"))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start(save_path)
