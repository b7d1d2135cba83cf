from . import batch_job, serving

__all__ = ["batch_job", "serving"]
