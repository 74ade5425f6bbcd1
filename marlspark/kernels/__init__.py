"""NumPy kernels on one image, mask or label at a time; operators run them inside Arrow batches."""
