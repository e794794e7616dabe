from ludomart.streaming.incremental import incremental_reviews

__all__ = ["incremental_reviews"]
