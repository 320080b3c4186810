"""Writers: delimited text, LIBSVM, Kafka (batch and stream), saved models."""

from .files import write_csv, write_libsvm
from .kafka import kafka_sink_options, write_messages
from .models import save_model
from .streams import start_batches, start_stream, wait
from .versions import LatestModel, ModelVersions

__all__ = [
    "LatestModel",
    "ModelVersions",
    "kafka_sink_options",
    "save_model",
    "start_batches",
    "start_stream",
    "wait",
    "write_csv",
    "write_libsvm",
    "write_messages",
]
