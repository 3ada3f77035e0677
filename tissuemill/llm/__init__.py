"""Operations of a large-scale training-data pipeline, as Spark jobs over ``documents`` and ``pages`` tables."""
