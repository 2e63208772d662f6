"""tidemark.sources"""
