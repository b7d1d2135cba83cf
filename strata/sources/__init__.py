from . import bindings
from .bootstrap import bootstrap_load
from .kafka import file_envelope_source, kafka_source, write_envelope
from .partitioned import read_partitioned, read_quarantine, stored_schema

__all__ = ["bindings", "bootstrap_load", "file_envelope_source", "kafka_source", "write_envelope",
           "read_partitioned", "read_quarantine", "stored_schema"]
