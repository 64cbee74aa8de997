"""Record sources: Kafka / file readers, decoding, the test-data adapter."""
