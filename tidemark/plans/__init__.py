"""The models: staging, intermediate, marts, finance and features."""
