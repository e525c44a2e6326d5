"""Operations of a training-data pipeline: ten operators, their queries and the SQL they are held against."""
